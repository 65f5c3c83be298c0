"""License scans by canonical digests of whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .frames import text_of

#: Equivalent spellings, as in the public guidelines for matching licence texts.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sublicence", "sublicense"), ("copyright holder", "copyright owner"), ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"), ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"), ("capitalisation", "capitalization"),
    ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"), ("customisation", "customization"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"), ("initialise", "initialize"),
    ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"), ("modelling", "modeling"), ("non commercial", "noncommercial"), ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"),
    ("per cent", "percent"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"), ("sub license", "sublicense"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"), ("merchantibility", "merchantability"),
)

# Public licence texts and the usual short notices.
_PERMISSION = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"
_AS_IS = "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_END = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_END = "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
_MIT = f"{_PERMISSION}, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n{_AS_IS}"
KNOWN = (
    ("MIT", _MIT),
    ("MIT", f"MIT License\n\n{_MIT}"),
    ("MIT", f"The MIT License (MIT)\n\n{_MIT}"),
    ("MIT-0", f"{_PERMISSION}.\n\n{_AS_IS}"),
    ("MIT-0", f"MIT No Attribution\n\n{_PERMISSION}.\n\n{_AS_IS}"),
    ("BSD-2-Clause", f"{_BSD}\n\n{_BSD_END}"),
    ("BSD-2-Clause", f"BSD 2-Clause License\n\n{_BSD}\n\n{_BSD_END}"),
    ("BSD-3-Clause", f"{_BSD}\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n{_BSD_END}"),
    ("BSD-3-Clause", f"BSD 3-Clause License\n\n{_BSD}\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\n{_BSD_END}"),
    ("ISC", f"{_ISC}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_END}"),
    ("ISC", f"ISC License\n\n{_ISC}, provided that the above copyright notice and this permission notice appear in all copies.\n\n{_ISC_END}"),
    ("0BSD", f"{_ISC}.\n\n{_ISC_END}"),
    ("0BSD", f"BSD Zero Clause License\n\n{_ISC}.\n\n{_ISC_END}"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may not be removed or altered from any source distribution."),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("MIT-notice", "Released under the MIT License."),
    ("CC-BY-NC-4.0-notice", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
)

# Whole texts that the SQL's list lacks, as canonical digests of the published texts; those that end in instructions also without them.
DIGESTS = (
    ("Apache-2.0", "045649cdaf85384ba827242062f2f3b36409835c98d297e25177cb1faf7c2847"),
    ("Apache-2.0", "108490d21e2d3edc9128233e48fabc169818d0c7c5f0bbdd58231a367d2d6c87"),
    ("GPL-2.0", "cf74dfa78ca9ac981c7ae9e50c4ecfb828df2e5ef2f1646368388676215766b5"),
    ("GPL-2.0", "c33d2f29477d94c3f3e48ae230c47966a4f4c05a0f6087cf607e1589848d2986"),
    ("GPL-3.0", "68ca42869e9a3e25843be66c6f296ce2b1f3629ac71d77465db0636dc8781c06"),
    ("GPL-3.0", "df20d6920a2688bef2bb6fb95fc7472aa40799a7027c0ce468190c67658a9656"),
    ("LGPL-2.0", "1862ecc2c3c5e3b9e88481e95603c88e089c43e9d5702b2ec01391491b606a9e"),
    ("LGPL-2.0", "e29dcc167f8a363847b3c4b0a7ced67d7a2bb7b9112a3311b6877a9c0570d635"),
    ("LGPL-2.1", "ac0856eb11aebb30c08445444c942c1ddcde9d0a0447c9ed2b8a19ab7d51eba5"),
    ("LGPL-2.1", "2858f5a00f6672bd47f63b69b9bf4e1bc31f3541b08a5a263e59d9b384f72fdc"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "1cfb6cca26abe2169c9c61164807107b2d4a0b64955a2cf2de46fad3483acda1"),
    ("MPL-2.0", "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
)
WHOLE = (
    ("Unlicense", "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\nIn jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.\n\nFor more information, please refer to <https://unlicense.org>"),
)

#: A line that is a copyright line: one with the word and a sign, a year, a placeholder or "by" after it, or with the sign alone, whatever stands before it as a comment mark; or "all rights
#: reserved". A wrapped line of a text that merely begins with the word stays.
_LINE = r"^[^\p{L}\p{N}\n]*(copyright\b[^\n]*(\(c\)|©|\b(19|20)[0-9][0-9]\b)[^\n]*|copyright[ \t]*([<{\[][^\n]*|by\b[^\n]*)?|\(c\)[ \t][^\n]*|©[^\n]*|all rights reserved[^\n]*)$"
COPYRIGHT, COPYRIGHT_SQL = f"(?imd){_LINE}", f"(?im){_LINE}"
OTHER = r"[^\p{L}\p{N}]+"


def canonical(text: Column) -> Column:
    """Copyright lines off, lower case, punctuation and white space as single blanks, equivalent spellings as one; the whole text."""
    plain = F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), COPYRIGHT, "")
    # Two blanks between words, so that a word's blanks are its own and neighbours are replaced alike.
    out = F.concat(F.lit(" "), F.regexp_replace(F.lower(plain), OTHER, "  "), F.lit(" "))
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(f" {a.replace(' ', '  ')} "), F.lit(f" {b.replace(' ', '  ')} "))
    return F.trim(F.replace(out, F.lit("  "), F.lit(" ")))


def known_licences(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """(license_digest, license_id) of the known texts; its size is that of the fixed list."""
    texts = spark.createDataFrame([*known, *WHOLE], "license_id string, text string").select(F.sha2(canonical(F.col("text")), 256).alias("license_digest"), "license_id")
    listed = spark.createDataFrame(list(DIGESTS), "license_id string, license_digest string")
    return texts.unionByName(listed).groupBy("license_digest").agg(F.min("license_id").alias("license_id"))


def scan_licences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """Id, license_digest and license_id (null if the whole text is no known licence) of every row.

    Texts are brought into canonical form and their digests joined to those of the known texts, which are a fixed list and so are sent to every executor. A null or
    empty text, or one of nothing but copyright lines and punctuation, has the digest of the empty text and no licence. Rows that repeat an id give a row each. A very long text
    is read whole. Other columns of df aren't carried; an id column named like one of the result's comes back with "_id" added. An empty table gives an empty table.
    """
    digest = F.sha2(canonical(text_of(text_col)), 256)
    name = f"{id_col}_id" if id_col.lower() in ("license_digest", "license_id") else id_col
    return (
        df.select(F.col(f"`{id_col}`").alias(name), digest.alias("license_digest"))
        .join(F.broadcast(known_licences(df.sparkSession, known)), "license_digest", "left")
        .select(F.col(f"`{name}`"), "license_digest", "license_id")
    )


def _quote(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def canonical_sql(column: str) -> str:
    """The canonical form as SQL, for checks against another engine: single words by a table of words, then the spellings of two words by pattern."""
    out = f"regexp_replace(regexp_replace(coalesce({column}, ''), '\\r\\n?', chr(10), 'g'), {_quote(COPYRIGHT_SQL)}, '', 'g')"
    out = f"string_split(trim(regexp_replace(lower({out}), {_quote(OTHER)}, ' ', 'g')), ' ')"
    names, others = zip(*[(_quote(a), _quote(b)) for a, b in SPELLINGS if " " not in a], strict=True)
    out = f"array_to_string(list_transform({out}, lambda w: coalesce(MAP {{{', '.join(f'{a}: {b}' for a, b in zip(names, others, strict=True))}}}[w], w)), ' ')"
    for a, b in SPELLINGS:
        if " " in a:
            out = f"regexp_replace({out}, '\\b{a}\\b', {_quote(b)}, 'g')"
    return out


def scan_sql(known: tuple[tuple[str, str], ...] = KNOWN) -> str:
    rows = ", ".join(f"({_quote(a)}, {_quote(b)})" for a, b in known)
    return f"""
        WITH known AS (SELECT sha256({canonical_sql('t')}) AS license_digest, min(k) AS license_id FROM (VALUES {rows}) AS v(k, t) GROUP BY 1),
        scanned AS (SELECT doc_id, sha256({canonical_sql('text')}) AS license_digest FROM documents)
        SELECT doc_id, license_digest, license_id FROM scanned LEFT JOIN known USING (license_digest)"""
