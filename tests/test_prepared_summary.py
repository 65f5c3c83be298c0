"""The summary of prepared posts: every measure, without posts too, and each text normalised once."""

from threadmill.plans.datasets import prepared_summary


def write(df, folder, name):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_every_measure_is_given(spark, tmp_path):
    texts = ["See https://x.com #Trend", "see  https://x.com #trend!", "See https://x.com #Trend", "\t ?! \n", "", None, "ask @ann, Élan", "plain", "  "]
    write(spark.createDataFrame([(2 * i + 2, t, "web") for i, t in enumerate(texts)], "doc_id long, text string, source string"), tmp_path, "documents")
    sf = write(spark.createDataFrame([(15, 1, 0), (10, 0, 1), (40, 1, 0)], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    got = [((r["measure"], r["key"]), r["value"]) for r in prepared_summary(spark, sf).collect()]
    assert len(got) == 14 and dict(got) == {
        ("row_count", ""): 10.0,  # 40 has a label only
        ("non_empty_raw_text_count", ""): 7.0,
        ("non_empty_clean_text_count", ""): 6.0,  # one is all marks
        ("blank_clean_text_count", ""): 4.0,
        ("duplicate_raw_text_rows", ""): 1.0,
        ("duplicate_clean_text_rows", ""): 2.0,
        ("flag", "has_hashtag"): 3.0,
        ("flag", "has_url"): 3.0,
        ("flag", "has_mention"): 1.0,
        ("flag", "has_special_chars"): 5.0,
        ("flag", "has_non_ascii"): 1.0,
        ("text_source", "hydrated_record_text"): 2.0,
        ("text_source", "raw_record_text"): 6.0,
        ("text_source", "none"): 2.0,
    }


def test_without_posts_and_with_each_normalised_once(spark, tmp_path):
    write(spark.createDataFrame([], "doc_id long, text string, source string"), tmp_path, "documents")
    sf = write(spark.createDataFrame([], "doc_id long, quality int, toxic int"), tmp_path, "labels")
    out = prepared_summary(spark, sf)
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    got = out.collect()
    assert len(got) == 11 and {r["value"] for r in got} == {0.0} and not [r for r in got if r["measure"] == "text_source"]
