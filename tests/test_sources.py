"""Files of every kind the readers meet."""

import bz2
import json

import pytest
from pyspark.sql import functions as F

from editpulse.operators import quality as Q
from editpulse.operators.joins import new_revisions
from editpulse.plans import pipeline as PL
from editpulse.schemas import ALL_FEATURES, BRONZE
from editpulse.sources import arrays as A
from editpulse.sources import bronze as B
from editpulse.sources import payloads as P
from editpulse.sources import tables as TB


def record(revid, **over):
    base = dict(page_title="P", page_id="9", page_watchers=1, revid=revid, parentid=0,
                timestamp="2024-03-01T00:00:00Z", user="u", userid=5, anon=False, size=10,
                comment="c", minor=False, bot=False, tags=["x"], collected_at=None)
    return {**base, **over}


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("bronze")
    (d / "array.json").write_text(json.dumps([record(1), record(2)]))
    (d / "lines.json").write_text("\n".join(json.dumps(record(i)) for i in (3, 4)))
    (d / "object.json").write_text(json.dumps(record(5)))
    (d / "pretty.json").write_text(json.dumps([record(6), record(7)], indent=2))
    (d / "cut.json").write_text(json.dumps([record(8)])[:-20])
    (d / "onebad.json").write_text(json.dumps(record(9)) + "\n{broken\n")
    (d / "blank.json").write_text("  \n ")
    (d / "binary.json").write_text("PK not json at all")
    (d / "zero.json").write_text("")
    return d


def test_line_reader(spark, files):
    rows = B.parse_records(B.read_lines(spark, f"{files}/*.json"))
    assert rows.schema == BRONZE
    assert sorted(r.revid for r in rows.filter("revid is not null").collect()) == [1, 2, 3, 4, 5, 9]


def test_bronze_reads_every_format(spark, files):
    rows = B.read_bronze(spark, f"{files}/*.json")
    assert rows.schema == BRONZE
    assert sorted(r.revid for r in rows.filter("revid is not null").collect()) == [1, 2, 3, 4, 5, 6, 7, 9]
    assert B.read_bronze(spark, f"{files}/blank.json").count() == 0


NASTY = ['}{', '"', '\\', '\\"', '[{]}', '\n', 'é}😀{', '},{"revid": 99}', '', ' ', '\\}']


def nasty_records(n):
    """Records whose texts are full of braces, quotes and escapes; some nested."""
    return [record(i, comment=NASTY[i % len(NASTY)] * (1 + i % 3), tags=[NASTY[(i * 7) % len(NASTY)]] * (i % 3), more={"a": [{"b": "}"}, {}], "c": {"d": {}}} if i % 4 == 0 else 1) for i in range(n)]


@pytest.mark.parametrize("split", [700, 5000, 1 << 20])
def test_arrays_in_any_split(spark, tmp_path, split):
    """Records come out whole wherever the splits fall: one-line and pretty arrays."""
    rows = nasty_records(44)
    (tmp_path / "one.json").write_text(json.dumps(rows, ensure_ascii=False))
    (tmp_path / "pretty.json").write_text("  \n" + json.dumps([dict(r, revid=r["revid"] + 1000) for r in rows], indent=3) + "\n\n")
    (tmp_path / "tight.json").write_text(json.dumps([dict(r, revid=r["revid"] + 2000) for r in rows], separators=(",", ":")))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(r) for r in [record(5000), record(5001)]))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = {r.revid: r for r in B.read_bronze(spark, f"{tmp_path}/*.json").collect()}
        formats = {r.file.rsplit("/", 1)[-1]: r.format for r in Q.file_audit(spark, f"{tmp_path}/*.json").collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert formats == {"one.json": "array_file", "pretty.json": "array_file", "tight.json": "array_file", "lines.json": "ndjson"}
    assert len(got) == 3 * 44 + 2
    for i, r in enumerate(rows):
        for base in (0, 1000, 2000):
            assert (got[i + base].comment, got[i + base].tags) == (r["comment"], r["tags"])


def test_one_array_is_read_by_many_tasks(spark, tmp_path):
    (tmp_path / "big.json").write_text(json.dumps([record(i, comment="}{" * 20) for i in range(4000)]))
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(-(-(tmp_path / "big.json").stat().st_size // 8)))
    try:
        parts = A.pieces(spark, f"{tmp_path}/big.json")
        sizes = parts.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max(F.length("value")).alias("longest")).collect()
        assert len(sizes) == 8 and max(r.n for r in sizes) < 4000 * 21 / 6 and max(r.longest for r in sizes) < 300
        assert B.read_bronze(spark, f"{tmp_path}/big.json").agg(F.count("*"), F.sum("revid")).first()[:] == (4000, 4000 * 3999 // 2)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


BROKEN = {
    "cut": lambda t: t[:-30], "no end": lambda t: t[:-1], "rest": lambda t: t + " x", "brace": lambda t: t + "}", "twice": lambda t: t + t, "comma": lambda t: t[:-1] + ",]",
    "no comma": lambda t: t.replace("}, {", "} {", 1), "quote": lambda t: t.replace('"user"', 'user"', 1), "nested": lambda t: f"[{t}]", "number": lambda t: "[1, " + t[1:],
    "colon": lambda t: t.replace(":", ";", 1), "word": lambda t: t[:-1] + ", null]", "late quote": lambda t: t[: len(t) // 2] + '"' + t[len(t) // 2 :],
}


@pytest.mark.parametrize("indent", [None, 1])
def test_broken_arrays_give_nothing(spark, tmp_path, indent):
    """Beside a sound file, which is read whole."""
    text = json.dumps([record(i) for i in range(20)], indent=indent)
    if indent:
        text = text.replace("},\n {", "}, {")
    (tmp_path / "sound.json").write_text(text)
    for how, damage in BROKEN.items():
        (tmp_path / f"{how}.json").write_text(damage(text))
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        assert sorted(r.revid for r in B.read_bronze(spark, f"{tmp_path}/*.json").collect()) == list(range(20))
        formats = {r.file.rsplit("/", 1)[-1]: r.format for r in Q.file_audit(spark, f"{tmp_path}/*.json").collect()}
        assert formats.pop("sound.json") == "array_file" and len(formats) == len(BROKEN) and set(formats.values()) == {"corrupt"}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


def test_pipeline_reads_arrays_over_lines(spark, tmp_path):
    """Silver holds the records of arrays over many lines, and a second landing of
    the same revisions adds none."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps([record(1), record(2)], indent=2))
    assert sorted(r.revid for r in PL.build_silver(spark, f"{tmp_path}/in/*.json", f"{tmp_path}/silver").collect()) == [1, 2]
    incoming = spark.createDataFrame([tuple(record(i).values()) for i in (2, 3)], BRONZE)
    PL.land(spark, incoming, f"{tmp_path}/in")
    assert sorted(r.revid for r in B.read_bronze(spark, f"{tmp_path}/in").collect()) == [1, 2, 3]


def test_wrong_type_keeps_the_record(spark):
    lines = spark.createDataFrame([(json.dumps(record(1, size="big")),)], "value string")
    row = B.parse_records(lines).first()
    assert row.revid == 1 and row["size"] is None


def test_wrong_type_inside_an_array(spark):
    lines = spark.createDataFrame(
        [(json.dumps([record(1, size="big"), record(2), record(3, tags="t")]),)], "value string")
    rows = {r.revid: r for r in B.parse_records(lines).collect()}
    assert set(rows) == {1, 2, 3}
    assert rows[1]["size"] is None and rows[2]["size"] == 10 and rows[3].tags is None


@pytest.mark.parametrize("text", [
    "", "null", "5", "[{\"revid\":", "not json", "[]", "[", '{"revid": 1},', '{"revid": 1}]',
    '{"revid": 1} rest', '{"revid": 1}{"revid": 2}', '{"revid": 1},{"revid": 2}',
    '[{"revid": 1}],[{"revid": 2}]', '[{"revid": 1}] [{"revid": 2}]'])
def test_bad_lines_yield_nothing(spark, text):
    lines = spark.createDataFrame([(text,)], "value string")
    assert B.parse_records(lines).count() == 0


def test_file_audit(spark, files):
    listed = spark.createDataFrame([(f"file://{files}/zero.json",)], "file string")
    found = {r.file.rsplit("/", 1)[-1]: r.format
             for r in Q.file_audit(spark, f"{files}/*.json").collect()}
    assert found == {
        "array.json": "array_file", "pretty.json": "array_file", "lines.json": "ndjson",
        "object.json": "ndjson", "onebad.json": "ndjson", "cut.json": "corrupt",
        "blank.json": "empty", "binary.json": "corrupt"}
    with_zero = Q.file_audit(spark, f"{files}/*.json", listed)
    assert [r.format for r in with_zero.collect()] == ["empty"]


def test_trailing_content_and_pretty_objects(spark, files):
    (files / "garbage.json").write_text(json.dumps([record(1)], indent=1) + "\nrest")
    (files / "arrays.json").write_text("[{\"revid\": 1}]\n[{\"revid\": 2}]")
    (files / "prettyobject.json").write_text(json.dumps(record(1), indent=1))
    found = {r.file.rsplit("/", 1)[-1]: r.format for r in Q.file_audit(spark, f"{files}/*.json").collect()}
    assert (found["garbage.json"], found["arrays.json"], found["prettyobject.json"]) == ("corrupt", "ndjson", "corrupt")
    assert {r.format: r.files for r in Q.file_format_counts(
        Q.file_audit(spark, f"{files}/*.json")).collect()}["array_file"] == 2


def test_record_audit_and_advice(spark):
    rows = spark.createDataFrame(
        [tuple(record(i, bot=i < 3, anon=i == 4, user=None if i == 5 else "u").values())
         for i in range(1, 7)], BRONZE)
    audit = Q.record_audit(rows)
    r = audit.first()
    assert (r.total_records, r.valid_records, r.bot_edits, r.anon_edits, r.bot_pct) == (6, 5, 2, 1, 40.0)
    advice = {a.topic: a.advice for a in Q.audit_recommendations(audit, 1).collect()}
    assert advice == {"records": "few_valid_records", "bots": "few_bot_records",
                      "files": "corrupt_files_skipped"}


def test_api_payload(spark):
    payload = {"query": {"pages": {
        "12": {"title": "T", "watchers": 4, "revisions": [
            {"revid": 1, "timestamp": "2024-01-01T00:00:00Z", "user": "a", "size": 3, "minor": ""},
            {"revid": 2, "parentid": 1, "timestamp": "2024-01-02T00:00:00Z", "anon": "", "bot": "",
             "tags": ["m"], "comment": "z", "userid": 8}]},
        "-1": {"title": "gone", "revisions": [{"revid": 3}]},
        "13": {"title": "empty"}}}}
    rows = P.parse_api_responses(
        spark.createDataFrame([(json.dumps(payload),), ("{}",), ("oops",)], "value string"),
        collected_at="now").orderBy("revid").collect()
    assert [r.revid for r in rows] == [1, 2]
    assert (rows[0].minor, rows[0].anon, rows[0].bot, rows[0].parentid, rows[0].comment,
            rows[0].page_watchers, rows[0].tags) == (True, False, False, 0, "", 4, [])
    assert (rows[1].user, rows[1].anon, rows[1].bot, rows[1]["size"], rows[1].userid,
            rows[1].tags, rows[1].collected_at) == ("Unknown", True, True, 0, 8, ["m"], "now")


XML = """<dump xmlns="http://example.org/export/">
  <siteinfo><sitename>x</sitename></siteinfo>
  <page>
    <title>Tom &amp; Jerry</title>
    <ns>0</ns>
    <id>7</id>
    <revision>
      <id>1</id>
      <timestamp>2024-01-01T00:00:00Z</timestamp>
      <contributor><username>ann</username><id>3</id></contributor>
      <minor/>
      <comment>first</comment>
      <text bytes="9" xml:space="preserve">abc&lt;/revision&gt;</text>
    </revision>
    <revision>
      <id>2</id><parentid>1</parentid>
      <timestamp>2024-01-02T00:00:00Z</timestamp>
      <contributor><ip>10.0.0.1</ip></contributor>
      <text/>
    </revision>
  </page>
  <page>
    <title>Bad id</title><ns>0</ns><id>8</id>
    <revision><id>x1</id><contributor/><text>hello</text></revision>
  </page>
</dump>
"""


@pytest.mark.parametrize("packed", [False, True])
def test_xml_dump(spark, tmp_path, packed):
    path = tmp_path / ("d.xml.bz2" if packed else "d.xml")
    path.write_bytes(bz2.compress(XML.encode()) if packed else XML.encode())
    rows = {r.comment + r.page_title + str(r.revid): r
            for r in P.read_xml_dump(spark, str(path)).collect()}
    first, second, bad = (rows[k] for k in (
        "firstTom & Jerry1", "Tom & Jerry2", "Bad idNone"))
    assert (first.page_id, first.user, first.userid, first.minor, first.anon, first["size"]) == (
        "7", "ann", 3, True, False, len("abc</revision>"))
    assert (second.page_id, second.user, second.parentid, second.anon, second["size"],
            second.minor) == ("7", "10.0.0.1", 1, True, 0, False)
    assert (bad.page_id, bad.user, bad["size"], bad.timestamp) == ("8", "Unknown", 5, "")
    sizes = {r.revid: r["size"] for r in P.read_xml_dump(spark, str(path), byte_size=True).collect()}
    assert sizes[1] == 9


def test_xml_pages_survive_splits(spark, tmp_path):
    """Headers are carried across splits when one page fills several."""
    revisions = lambda page: "".join(
        f"<revision><id>{page * 1000 + i}</id><contributor><username>u{i}</username></contributor>"
        f"<text>{'t' * (i % 50)}</text></revision>\n" for i in range(1000))
    path = tmp_path / "big.xml"
    path.write_text("<dump>" + "".join(
        f"<page><title>page {p}</title><id>{p}</id>\n{revisions(p)}</page>\n" for p in range(5)) + "</dump>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = P.read_xml_dump(spark, str(path))
        good = rows.filter(
            (F.col("page_title") == F.concat(F.lit("page "), F.floor(F.col("revid") / 1000).cast("string")))
            & (F.col("size") == F.col("revid") % 1000 % 50))
        assert rows.count() == 5000 and good.count() == 5000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_manifest(spark):
    lines = spark.createDataFrame(
        [("aa  w-1-p1p9.xml.bz2",), ("",), ("lonely.xml.bz2",), ("bb  w-1.sql.gz",),
         ("  cc   dir/w-2.xml.bz2 ",)], "value string")
    assert [r[0] for r in P.parse_manifest(lines).collect()] == ["w-1-p1p9.xml.bz2", "dir/w-2.xml.bz2"]


def test_batches_are_bounded(spark, tmp_path, golden):
    B.write_batches(golden, str(tmp_path / "b"), batch_size=4)
    back = B.read_lines(spark, str(tmp_path / "b"))
    assert back.count() == golden.count()
    assert max(r["count"] for r in back.groupBy("file").count().collect()) <= 4


def test_append_only_new(spark, golden):
    stored = golden.filter("revid <= 3")
    assert sorted(r.revid for r in new_revisions(golden, stored).collect()) == [4, 5, 6, 7, 8]


def test_increment_keeps_other_months(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, 2024, 1), (2, 2024, 2)], "revid int, year int, month int")
    TB.write_silver(rows, path)
    TB.write_silver(rows.filter("month = 2").withColumn("revid", F.lit(9)), path, increment=True)
    assert sorted(r.revid for r in spark.read.parquet(path).collect()) == [1, 9]
    TB.write_silver(rows.filter("month = 2"), path)
    assert spark.read.parquet(path).count() == 1


def test_staged_pipeline(spark, tmp_path, golden):
    bronze, silver, feats, gold, kpis = (str(tmp_path / n) for n in "bsfgk")
    PL.land(spark, golden.limit(3), bronze, first=True)
    PL.land(spark, golden, bronze)
    assert PL.build_silver(spark, bronze, silver).count() == 7
    table = PL.build_features(spark, silver, feats)
    assert table.count() == 7 and set(ALL_FEATURES) <= set(table.columns)
    PL.build_kpis(spark, silver, feats, kpis)
    assert spark.read.json(f"{kpis}/dataset").first().total_edits == 7
    assert spark.read.json(f"{kpis}/reverts").first().revert_candidates == 1


def test_audit_files_of_all_kinds_are_written_by_one_job(spark, sf_dir, monkeypatch):
    from pyspark.sql import DataFrameWriter
    from editpulse.catalog import quality as CQ
    writes, real = [], DataFrameWriter.text

    def counted(self, path, *rest, **more):
        writes.append(path)
        return real(self, path, *rest, **more)
    monkeypatch.setattr(DataFrameWriter, "text", counted)
    found = {(r.folder, r.format): r.files for r in CQ.file_audit(spark, sf_dir).collect()}
    assert len(writes) == 1 and len(set(found.values())) == 1
    assert set(found) == {("lines", "ndjson"), ("broken", "corrupt"), ("arrays", "array_file"), ("blank", "empty")}
