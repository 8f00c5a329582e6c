"""The attachment walk and the field conversions: one cheap pass a line, same values."""

import random

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidewater.plans import q_ingest as Q
from tidewater.sources import fixed_width as FW


def walk(line: str) -> list[tuple[str, str]]:
    """The attachments of a line, position by position."""
    out, pos = [], FW.CORE_LENGTH
    while pos + 1 < len(line):
        att_id = line[pos:pos + 2].strip(" ")
        n = FW.ATTACHMENT_LENGTH.get(att_id)
        if n is None:
            break
        end = pos + n if n else len(line)
        out.append((att_id, line[pos:end]))
        pos = end
    return out


def test_walk_of_random_lines(spark):
    rng = random.Random(3)
    heads = [" 1", "1 ", " 5", "6 ", " 7", " 8", "9 ", "95", "96", "97", "98", "99", "  ", "??", "1", ""]
    lines = [None, "", " " * 108, "é" * 107]
    for _ in range(400):
        tail = ""
        for _ in range(rng.randint(0, 6)):
            head = rng.choice(heads)
            n = FW.ATTACHMENT_LENGTH.get(head.strip(), 9) or rng.randint(0, 20)
            tail += head + "".join(rng.choices("0 9Aé\n\r😀", k=max(0, n - len(head))))
        lines.append(rng.choice(["x", "é"]) * 108 + tail[:rng.randint(0, len(tail))])
    df = spark.createDataFrame(list(enumerate(lines)), "n int, value string")
    got = {r.n: r.att for r in FW.attachments(df).collect()}
    assert got[0] is None
    for i, line in enumerate(lines[1:], 1):
        assert [(a.id, a.body) for a in got[i]] == walk(line), line


def test_sections_are_walked_once_a_use(spark):
    plan = Q._section_rows(spark, SF_SMALL, Q._OBSERVED)._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in plan and plan.count("regexp_extract_all(") <= 2


def test_numbers_as_a_cast_reads_them(spark):
    texts = ["", " ", "7", "a", "Z", "é", "12", " 1", "1 ", "+1", "-0", "-", "1 2", "1.", ".5", ".", "1e3", "1e", "1d", "2F", "NaN",
             "nan", "inf", "-Inf", "+infinity", "Infinityx", "0x1p3", "0x", "1\t", "\x011", "1A-", "1_0", "٣", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for width in (1, 9):
        raw = F.substring("t", 1, width)
        rows = df.select("t", FW._convert(raw, width, None, 1).cast("string").alias("got"),
                         F.trim(raw).try_cast("double").cast("string").alias("want"),
                         FW._convert(raw, width, None, 2).alias("b36"),
                         F.when(F.trim(raw).rlike("^[0-9A-Za-z]+$"), F.conv(F.trim(raw), 36, 10).try_cast("double")).alias("b36_want"))
        for r in rows.collect():
            assert (r.got, r.b36) == (r.want, r.b36_want), (width, r)


def test_linkage_of_a_long_call_sign_streams(spark):
    """A call sign's rows are sorted and streamed, not collected into one value that grows with them."""
    import datetime

    from tidewater.operators import metadata as MD

    day = datetime.date(2000, 1, 1)
    rows = [(i, 1990 + i % 20, "C1", "SEA STAR", "GB", 1, "MN"[i % 2], 5.0, day, day + datetime.timedelta(days=i)) for i in range(6000)]
    df = spark.createDataFrame(rows, "line long, edition int, call string, name string, rcnty string, cls int, kind string, "
                                     "height double, valid_from date, valid_to date")
    out = MD.link_editions(df, ["cls", "kind", "height"], ["cls", "height"])
    assert "collect_list" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = out.collect()
    # odd editions hold kind N only, even ones M: the newest record absorbs its own kind, others are new
    assert sum(len(r.source_file.split(";")) for r in got) == 6000


def test_name_similarity_builds_no_table_of_columns(spark):
    from tidewater.operators import metadata as MD

    df = spark.createDataFrame([("SEA STAR", "SEA STARR"), (None, ""), ("é😀x", "😀é"), ("A", None)], "a string, b string")
    out = df.select(MD.name_similarity("a", "b").alias("r"), MD.names_alike(F.col("a"), F.col("b"), 0.8).alias("s"))
    assert "aggregate(" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert [(r.r, r.s) for r in out.collect()] == [(16 / 17, True), (1.0, True), (2 / 5, False), (0.0, False)]


def test_wide_scans_are_not_shuffled(spark, tmp_path):
    from tidewater.plans import adapters as A

    path = str(tmp_path / "lineitem.parquet")
    spark.range(0, 64, 1, 16).selectExpr("id AS l_orderkey").write.parquet(path)
    text = "SELECT l_orderkey AS k FROM $lineitem"
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))  # a task for every few files
    try:
        assert A._wide_scan(spark, str(tmp_path), text)
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    narrow = tmp_path / "narrow"
    spark.range(0, 64, 1, 1).selectExpr("id AS l_orderkey").write.parquet(str(narrow / "lineitem.parquet"))
    assert not A._wide_scan(spark, str(narrow), text)
    assert sorted(r.k for r in A.view(spark, str(narrow), text).collect()) == list(range(64))
    assert sorted(r.k for r in A.view(spark, str(tmp_path), text).collect()) == list(range(64))


def test_tagged_lines_are_written_compressed_without_a_sort(spark, tmp_path):
    line = " " * 108 + " 165" + " " * 6 + "926101 5" + " " * 45 + "12"
    lines = spark.createDataFrame([(line,), (line,), (" " * 108,)], "value string")
    FW.partition_lines(lines, str(tmp_path / "t"), compression="gzip")
    assert list((tmp_path / "t").glob("tag=*/*.txt.gz"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "t") + "/*").collect()) == sorted([line, line, " " * 108])
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_months_keep_the_record_that_began_last(spark, tmp_path):
    import datetime as dt

    from tidewater.sources import sinks

    d = dt.date
    rows = [(4, "C1", "GB", d(2000, 1, 1), d(2000, 3, 1)), (3, "C1", "GB", d(2000, 1, 1), d(2000, 2, 10)),
            (9, "C1", "GB", d(2000, 1, 20), d(2000, 2, 10)), (9, "C1", "NL", d(2000, 1, 20), d(2000, 2, 10)),
            (None, "C2", "GB", d(2000, 1, 1), d(2000, 1, 5)), (5, "NULL", "GB", d(2000, 1, 1), d(2000, 1, 5))]
    df = spark.createDataFrame(rows, "line long, call string, rcnty string, valid_from date, valid_to date")
    sinks.write_layouts(df, str(tmp_path / "l"), "v4")
    got = spark.read.csv(str(tmp_path / "l/monthly"), sep="|", header=True).collect()
    assert sorted((str(r.month), r.line, r.rcnty) for r in got) == [
        ("2000-01", "3", "GB"), ("2000-02", "9", "GB"), ("2000-02", "9", "NL"), ("2000-03", "4", "GB")]


def test_records_are_dealt_before_they_merge(spark):
    """Parts of the shuffle's size, and not of the files', are sorted to merge station records."""
    from tidewater.operators import summaries as SU
    from tidewater.plans import adapters as A, q_runs

    plan = SU.station_state(A.view(spark, SF_SMALL, q_runs._records_sql()), ["year"])._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan
