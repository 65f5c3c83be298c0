"""Part of the social-text analytics engine."""
