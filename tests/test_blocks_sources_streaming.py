import json

import pytest
from pyspark.sql import functions as F

from strataline.operators import blocks as B
from strataline.sources import packages as P
from strataline.streaming import incremental as I


def test_normalize_and_table():
    assert B.normalize_text("a   b ​\n\n\n\nｃ  d ") == "a b\n\nc d"
    got = B.html_table_to_markdown("<table><tr><th>a|b</th><th>c</th></tr><tr><td>1<br>2</td></tr></table>")
    assert got == "| a\\|b | c |\n| --- | --- |\n| 1 2 |  |"
    assert B.html_table_to_markdown("<table></table>x") == "<table></table>x"


def test_markdown_blocks_keep_offsets():
    text = "# T\npara one\nstill\n\n| a | b |\n| 1 | 2 |\nafter\n<table><tr><td>x</td></tr></table>\n## U\nend"
    made = B.markdown_blocks(text)
    assert [b.kind for b in made] == ["heading", "paragraph", "table", "paragraph", "table", "heading", "paragraph"]
    for b in made:
        if b.kind == "paragraph":
            assert text[b.start : b.end].strip() == b.text


def test_pack_keeps_all_words_and_limits():
    text = " ".join(f"Sentence number {k} ends here." for k in range(80)) + " " + "x" * 500
    pieces = B.pack(text, 200, 40)
    assert all(len(p) <= 200 for p in pieces)
    assert "".join(pieces).replace(" ", "") == text.replace(" ", "")
    assert B.pack("", 100, 10) == []


def test_chunks_have_heading_paths(spark):
    text = "# A\n\nintro text\n\n## B\n\n" + "word " * 700 + "\n\n| h |\n| - |\n" + "\n".join(f"| {k} |" for k in range(40)) + "\n\n# C\n\nlast"
    df = spark.createDataFrame([(1, text), (2, None), (3, "  "), (4, "plain")], "doc_id int, text string").withColumn("kind", F.lit("clash"))
    got = B.chunk_documents(df, "doc_id", limit=1000).orderBy("doc_id", "chunk_index").collect()
    assert {r["title_context"] for r in got if r["doc_id"] == 1} == {"A", "A > B", "C"}
    assert all(len(r["text"]) <= 1000 for r in got if r["kind"] == "section")
    assert sum(r["kind"] == "table" for r in got) == 5
    assert {r["doc_id"] for r in got} == {1, 4}


def test_chunks_lie_at_their_offsets():
    bare = lambda s: "".join(s.split())
    long = "  Alpha beta.  Gamma\ndelta. 第一句。第二句。 " + " ".join(f"Sentence {k % 3} ends here." for k in range(60)) + " " + "x" * 900
    pipe = "| h |\n| - |\n" + "\n".join(f"| {k} |" for k in range(12))
    page = "<table>\n<tr><th>h</th></tr>\n" + "\n".join(f"<tr>\n<td>r{k}</td></tr>" for k in range(12)) + "\n</table>"
    loose = "<table><caption\n>head</caption>\nline &amp; 1\n\n\n\n" + "\n".join(f"<i>line</i> {k}" for k in range(2, 14)) + "</table>"
    text = f"# A\n\nintro\n\n{long}\n\ntail\n\n{pipe}\n\n# B\n{page}\nafter\n\n{loose}"
    made = B.chunk_blocks(B.markdown_blocks(text), limit=300)
    sections = [c for c in made if c.kind == "section"]
    assert len(sections) > 8 and all(bare(text[c.start : c.end]) == bare(c.text) for c in sections)
    tables = [[c for c in made if c.kind == "table" and text.index(t) <= c.start < text.index(t) + len(t)] for t in (pipe, page, loose)]
    assert [len(t) for t in tables] == [3, 3, 3]
    for parts, last in zip(tables, ("| 11 |", "<td>r11</td>", "<i>line</i> 13")):
        assert all(a.end <= b.start for a, b in zip(parts, parts[1:])) and last in text[parts[2].start : parts[2].end]
    assert [text[c.start : c.end] for c in tables[0][1:]] == ["\n".join(c.text.split("\n")[2:]) for c in tables[0][1:]]
    for c in tables[1][1:]:
        assert [r.split("<td>")[1].split("<")[0] for r in text[c.start : c.end].split("<tr>")[1:]] == [r.strip("| ") for r in c.text.split("\n")[2:]]
    for c in tables[2][1:]:
        own = c.text.split("\n")[2:]
        assert own[0].split()[-1] in text[c.start : c.start + 20] and own[-1].split()[-1] in text[c.end - 20 : c.end]


def test_jsonl_round_trip_and_inventory(spark, tmp_path):
    df = spark.createDataFrame([("b", 1), (None, 2)], "z string, a int")
    P.write_jsonl(df, str(tmp_path / "pack" / "rows"))
    back = P.read_jsonl(spark, str(tmp_path / "pack" / "rows"), "z string, a int")
    assert {tuple(r) for r in back.collect()} == {("b", 1), (None, 2)}
    inventory = P.checksums(spark, str(tmp_path / "pack"), "*.json").cache()
    assert P.verify(inventory, inventory.select("name", "sha256")).count() == 0
    name = inventory.first()["name"]
    wrong = spark.createDataFrame([(name, "0"), ("gone", "1"), ("twice", "1"), ("twice", "1")], "name string, sha256 string")
    problems = {r["name"]: r["problem"] for r in P.verify(inventory, wrong).collect()}
    assert problems["gone"] == "missing" and problems["twice"] == "duplicate" and problems[name] == "changed"


def test_broken_jsonl(spark, tmp_path):
    path = tmp_path / "x.json"
    path.write_text('{"a": 1}\nnot json\n')
    with pytest.raises(Exception):
        P.read_jsonl(spark, str(path), "a int").collect()
    assert P.read_jsonl(spark, str(path), "a int", strict=False).cache().where("_corrupt is not null").count() == 1


def test_ocr_pdf_jsonp_abstract(spark, tmp_path):
    page = {"prunedResult": {"parsing_res_list": [{"block_label": "text", "block_content": "hello", "block_bbox": [0, 0, 1, 1]}]}}
    (tmp_path / "ocr").mkdir()
    (tmp_path / "ocr" / "result.json").write_text(json.dumps({"layoutParsingResults": [page, page]}))
    got = P.read_ocr_blocks(spark, str(tmp_path / "ocr")).orderBy("page").collect()
    assert [(r["page"], r["block_index"], r["text"]) for r in got] == [(0, 0, "hello"), (1, 0, "hello")]
    (tmp_path / "pdf").mkdir()
    (tmp_path / "pdf" / "good.pdf").write_bytes(b"%PDF-1.4\n" + b"/Type /Page \n" * 2 + b"/Type /Pages \n" + b" " * 1100 + b"%%EOF\n")
    (tmp_path / "pdf" / "bad.pdf").write_bytes(b"x")
    files = spark.read.format("binaryFile").load(str(tmp_path / "pdf"))
    seen = {r["path"].rsplit("/", 1)[-1]: (r["pages"], r["problem"]) for r in P.inspect_pdf(files).collect()}
    assert seen == {"good.pdf": (2, None), "bad.pdf": (0, "too_small")}
    df = spark.createDataFrame([('cb({"a": 3});',), ('{"a": 4}',), ("[1]",), (None,)], "t string")
    assert [r[0] for r in df.select(P.parse_jsonp(F.col("t"), "a int")["a"]).collect()] == [3, 4, None, None]
    words = spark.createDataFrame([({"b": [1], "a": [0, 2]},)], "m map<string,array<int>>")
    assert words.select(P.abstract_from_index(F.col("m"))).first()[0] == "a b a"


def test_stream_matches_batch_and_replay(spark, tmp_path):
    df = spark.createDataFrame([(k % 7, f"2024-01-0{1 + k % 3} 00:00:00", float(k)) for k in range(40)], "id int, ts string, v double")
    df.repartition(4).write.parquet(str(tmp_path / "in"))
    target = str(tmp_path / "out")
    for run in ("a", "b"):  # the second run replays everything
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        q = stream.writeStream.foreachBatch(I.append_new(target, "id")).option("checkpointLocation", str(tmp_path / run)).trigger(availableNow=True).start()
        q.awaitTermination()
        assert sorted(r["id"] for r in spark.read.parquet(target).collect()) == list(range(7))
    counts = I.windowed_counts(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "ts", "1 day")
    q = counts.writeStream.format("memory").queryName("daily").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    want = {(r["window"]["start"], r["n"]) for r in I.windowed_counts(df, "ts", "1 day").collect()}
    assert {(r["window"]["start"], r["n"]) for r in spark.table("daily").collect()} == want
    once = I.first_arrivals(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "id", "ts", "30 days")
    q = once.writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("once").count() == 7
    assert I.sessions(df, "ts", "1 hour", "id").count() == 21
    assert I.snapshot([df, df], "id").count() == 7
