import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strataline.functions import metadata as M
from strataline.functions import text as T
from strataline.functions.labels import label, language_label, latest, split_label


def one(spark, values, column, schema="t string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], schema).select(column).collect()]


def test_labels(spark):
    assert one(spark, [" A ", "", None, "b"], label(F.col("t"))) == ["a", "unknown", "unknown", "b"]
    assert one(spark, ["en-GB", "zh_Hans", " ", None], language_label(F.col("t"))) == ["en", "zh", "unknown", "unknown"]
    assert one(spark, [" Train", "", None], split_label(F.col("t"))) == ["train", None, None]


def test_latest_takes_greatest_and_is_stable(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, None)], "k string, o int, v string")
    assert {tuple(r) for r in latest(df, "k", "o").collect()} == {("a", 2, "z"), ("b", None, None)}


def test_numbers_and_guard(spark):
    assert one(spark, ["up 5.2% to 1,200 in 2024", "none", None], T.guard_signature(F.col("t"))) == ["5.2% 1,200 2024", "", ""]


def test_redaction(spark):
    got = one(spark, ["mail a.b@c.example or 13812345678", "order 213812345678900", "+86 138-1234-5678, 010-12345678; x@y.example"], T.redacted(F.col("t")))
    assert got == ["mail <EMAIL> or <PHONE>", "order 213812345678900", "<PHONE>, <PHONE>; <EMAIL>"]
    emails, phones = T.contacts(F.col("t"))
    assert one(spark, ["x@y.example 13812345678 13912345678", None], F.concat(emails.cast("string"), phones.cast("string"))) == ["12", None]


def test_noise(spark):
    lines = ["", "----", " \t ", "an sch enviofl dive Bosidenghaitwchaitabeouatioanluervicam", "Boid com.Thisindgoocvavrctlornctlnacr perforl performance.", "a" * 31,
             "a   .   .   ", "| A | B |", "ESG performance improves firm value.", "The report was filed in May."]
    assert one(spark, lines, T.noise_line(F.col("t"))) == [True, True, True, True, True, True, True, True, False, False]


def test_language_quality_heading(spark):
    assert one(spark, ["中文报告", "an English text"], T.detected_language(F.col("t"))) == ["zh", "en"]
    assert one(spark, ["", "a an", "short words only", "a" * 18, "forward-looking-statements"], T.long_word_score(F.col("t"))) == [0.0, 0.0, 100.0, 0.0, 0.0]
    assert one(spark, ["### x", "#x", "1.2 Net sales", " ## y"], T.heading_level(F.col("t"))) == [3, 2, 2, 2]
    titles = ["1. Introduction", "1.2 Net sales", "Introduction", "2024 results"]
    assert one(spark, titles, T.heading_level(F.col("t"), F.lit("paragraph_title"))) == [3, 3, 2, 3]
    assert one(spark, ["Paper Title", "1. A"], T.heading_level(F.col("t"), F.lit("doc_title"))) == [1, 1]
    heads = ["## 7. References", "参考文献：", "参考资料：", "第三章 参考文献", "Bibliography", "References are below", "References to data sources are provided below.", "Works cited"]
    assert one(spark, heads, T.reference_heading(F.col("t"))) == [True, True, True, True, True, False, False, False]
    labels = ["doc_title", "abstract", "header", "vision_footnote", "chart", "algorithm", "table_title", "other", None]
    assert one(spark, labels, T.content_type(F.col("t"))) == ["heading", "paragraph", "noise", "noise", "figure", "algorithm", "paragraph", "paragraph", "paragraph"]
    assert one(spark, ["1. Introduction", "# Marked ", "Plain"], T.governed_part(F.col("t"), F.lit("paragraph_title"))) == ["### 1. Introduction", "# Marked", "## Plain"]
    assert one(spark, ["The forward-looking fund and the fund"], T.topic_words(F.col("t"))) == [["forward-looking", "fund", "fund"]]
    assert one(spark, ["forward-looking"], T.title_case(F.col("t"))) == ["Forward-Looking"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(min_size=0, max_size=20), min_size=1, max_size=4))
def test_stable_uid_matches_plain_python(spark, parts):
    blank = [p.strip(" ") for p in parts]
    want = hashlib.sha256("|".join(blank).encode("utf-8", "surrogatepass")).hexdigest()[:32]
    df = spark.createDataFrame([tuple(parts)], ", ".join(f"c{k} string" for k in range(len(parts))))
    assert df.select(T.stable_uid(*[F.col(f"c{k}") for k in range(len(parts))])).first()[0] == want


def test_metadata(spark):
    assert one(spark, ["2024", "1800", "x", None], M.year(F.col("t"))) == [2024, None, None, None]
    assert [str(x) for x in one(spark, ["2024-02-30", "2024-02-29", "soon"], M.iso_date(F.col("t")))] == ["None", "2024-02-29", "None"]
    assert one(spark, ["年报", "Interim", "x", None], M.report_type(F.col("t"))) == ["annual", "semiannual", None, None]
    urls = ["https://www.A.example/x/?utm_source=1", "//m.a.example/x", "http://a.example/x#top", "", None]
    assert one(spark, urls, M.canonical_url(F.col("t"))) == ["a.example/x", "a.example/x", "a.example/x", None, None]
    assert re.match("a", "a")
