import calendar
import datetime
import random

import pytest
from pyspark.sql import functions as F

from pairworks.functions import pg
from pairworks.operators.mask import KINDS, column_kind, mask
from pairworks.session import cut_lineage, scratch_path, shared_folder, spread
from pairworks.sources import jsonl
from pairworks.streaming import ingest

DECADE = {"decade_start": "2020-01-01", "as_of": "2026-06-30"}


def test_mask_kinds(spark):
    df = spark.sql("""SELECT 1 AS id, 2.5D AS amount, true AS ok, 'Alice' AS name, 'a@b.c' AS user_email, 'bob' AS username, 'x' AS datetime_txt,
        'y' AS runtime, 'free text' AS note, DATE '1999-01-01' AS day, TIMESTAMP '1999-01-01 01:02:03' AS at, 1.25BD AS price, TIME '10:00:00' AS clock""")
    kinds = [column_kind(f) for f in df.schema.fields]
    assert kinds == ["keep", "keep", "keep", "name", "email", "name", "date_text", "time_text", "word", "date", "datetime", "text", "time"]
    r = mask(df, salt="s", **DECADE).first()
    assert (r.id, r.amount, r.ok, r.price) == (1, 2.5, True, "1.25")
    assert r.name != "Alice" and "@" in r.user_email and " " in r.username
    for text in (r.day, r.datetime_txt, r.at[:10]):
        assert datetime.date(2020, 1, 1) <= datetime.date.fromisoformat(text) <= datetime.date(2026, 6, 30)
    assert datetime.time.fromisoformat(r.runtime) and datetime.time.fromisoformat(r.clock) and len(r.at) == 19
    assert KINDS[0] == "email"


def test_mask_is_stable_and_salted(spark):
    df = spark.sql("SELECT id, CAST(id % 5 AS string) AS note, CASE WHEN id % 4 = 0 THEN CAST(id AS string) END AS name FROM range(40)")
    one, again, other = [mask(df.repartition(n), salt=s).orderBy("id").collect() for n, s in ((1, "a"), (7, "a"), (1, "b"))]
    assert one == again and [r.note for r in one] != [r.note for r in other]
    assert all((r.name is None) == (r.id % 4 != 0) for r in one)
    assert len({r.note for r in one if r.id % 5 == 1}) == 1


def test_mask_strict_hides_keys(spark):
    df = spark.createDataFrame([(7, "u1")], "patient_id int, note string")
    assert mask(df).first().patient_id == 7
    hidden = mask(df, strict=True, keys=("patient_id",), salt="s").first().patient_id
    assert hidden != "7" and hidden == mask(df, strict=True, keys=("patient_id",), salt="s").first().patient_id
    assert mask(df, rules={"note": "email"}).first().note.endswith("@example.org")


def pg_age(hi, lo):
    """Plain calendar arithmetic, as a check."""
    sign = 1
    if hi < lo:
        hi, lo, sign = lo, hi, -1
    months, days = (hi.year - lo.year) * 12 + hi.month - lo.month, hi.day - lo.day
    if days < 0:
        months, days = months - 1, days + calendar.monthrange(lo.year, lo.month)[1]
    return sign * months, sign * days


def test_age(spark):
    rng = random.Random(2)
    day = lambda: datetime.date(1990, 1, 1) + datetime.timedelta(days=rng.randrange(14000))
    rows = [(day(), day()) for _ in range(1000)]
    got = spark.createDataFrame(rows, "a date, b date").select(pg.age(F.col("a"), F.col("b")).alias("x")).collect()
    assert [tuple(r.x) for r in got] == [(*pg_age(a, b), 0) for a, b in rows]


def test_substring_starts_before_the_text(spark):
    cases = [((0, 2), "h"), ((-2, 4), "h"), ((-2, 2), ""), ((2, 3), "ell"), ((4, 99), "lo"), ((1, 0), "")]
    got = spark.sql("SELECT 'hello' AS s").select(*[pg.substring(F.col("s"), a, n).alias(f"c{i}") for i, ((a, n), _) in enumerate(cases)]).first()
    assert list(got) == [want for _, want in cases]


def test_extract_to_char_and_others(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-03-10 21:05:09.250' AS t, CAST(NULL AS string) AS n")
    x = lambda part: pg.extract(part, F.col("t"))
    row = df.select(x("dow"), x("isodow"), x("epoch"), x("month"), pg.to_char(F.col("t"), "DD Mon YYYY, HH12:MI:SS AM Q"),
                    pg.concat(F.lit("a"), F.col("n"), F.lit(1)), pg.trim(F.lit(" \tx ")), pg.integer_divide(F.lit(-7), F.lit(2))).first()
    assert list(row) == [0, 7, 1710104709.25, 3, "10 Mar 2024, 09:05:09 PM 1", "a1", "\tx", -3]


def test_to_char_fields(spark):
    df = spark.sql("SELECT timestamp'2001-03-05 13:04:09.123456' AS t")
    want = {"YYYY-MM-DD HH24:MI": "2001-03-05 13:04", "yyyy-mm-dd": "2001-03-05", "MONTH|Month|month": "MARCH    |March    |march    ", "FMMonth DD": "March 05",
            "IW D ID Q CC": "10 2 1 1 21", 'HH12:MI am "on" Dy': "01:04 pm on Mon", "FMHH24 MS US SSSSS": "13 123 123456 47049", "DAY|FMDay": "MONDAY   |Monday"}
    assert {p: df.select(pg.to_char(F.col("t"), p)).first()[0] for p in want} == want
    for unknown in ("YYYY foo", '"open', "9.9.9", "999 foo", "9RN", "99.9,9"):
        with pytest.raises(ValueError):
            pg.to_char(F.col("t"), unknown)


def test_age_and_extract_with_time_of_day(spark):
    df = spark.sql("SELECT timestamp'2001-01-02 00:00' AS a, timestamp'2001-01-01 12:00' AS b, timestamp'2005-06-07 08:09:10.5' AS t")
    ages = df.select(pg.age(F.col("a"), F.col("b")).alias("x"), pg.age(F.col("b"), F.col("a")).alias("y")).first()
    half = 12 * 3600 * 10**6
    assert tuple(ages.x) == (0, 0, half) and tuple(ages.y) == (0, 0, -half)
    parts = ["isoyear", "decade", "century", "millennium", "milliseconds", "microseconds"]
    assert tuple(df.select(*[pg.extract(p, F.col("t")) for p in parts]).first()) == (2005, 200, 21, 3, 10500.0, 10500000)
    assert [r[0] for r in spark.createDataFrame([(2.5,), (3.5,)], "x double").select(pg.round_double(F.col("x"))).collect()] == [2.0, 4.0]


def test_null_order(spark):
    df = spark.sql("SELECT * FROM VALUES (1, NULL), (2, 'b'), (3, 'a') AS t(id, v)")
    got = df.select("id", F.row_number().over(pg.ordered([], "v")).alias("n")).collect()
    assert {r.id: r.n for r in got} == {3: 1, 2: 2, 1: 3}


def test_shared_folder(spark, monkeypatch):
    assert scratch_path(spark, "x").startswith(shared_folder(spark))

    class Cluster:
        class sparkContext:
            master = "spark://host:1"
            getConf = staticmethod(lambda: {})
        conf = {}

    with pytest.raises(ValueError):
        shared_folder(Cluster)
    Cluster.sparkContext.getConf = staticmethod(lambda: {"spark.checkpoint.dir": "hdfs:///shared"})
    assert scratch_path(Cluster, "x").startswith("hdfs:///shared/pairworks/x-")


def test_cut_lineage_and_spread(spark):
    df = cut_lineage(spark.range(10).withColumn("a", F.array("id")))
    assert df.count() == 10 and "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(spark.range(0, 10, 1, 50)).rdd.getNumPartitions() == 50


def reply(i, n):
    return (i, f'{{"question": "q{n}", "sql": "SELECT {n};"}}\n{{"question": "bad", "sql": "FAIL"}}')


def test_stream_adds_only_new_pairs(spark, tmp_path):
    source, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    run = lambda: ingest.stream_ingest(spark, source, out, state).awaitTermination()
    for rows in ([reply(1, 1), reply(2, 1), reply(3, 2)], [reply(4, 2), reply(5, 3)], []):
        if rows:
            jsonl.append_jsonl(spark.createDataFrame(rows, ingest.REPLIES), source)
        run()
    got = ingest.read_pairs(spark, out).orderBy("task_id").collect()
    assert [(r.task_id, r.question, r.sql) for r in got] == [(1, "q1", "SELECT 1"), (3, "q2", "SELECT 2"), (5, "q3", "SELECT 3")]


def test_stream_survives_a_repeated_batch(spark, tmp_path):
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    jsonl.append_jsonl(spark.createDataFrame([reply(1, 1), reply(2, 2)], ingest.REPLIES), source)
    # losing the state repeats batch 0 from the start
    for state in ("state1", "state2"):
        ingest.stream_ingest(spark, source, out, f"{tmp_path}/{state}").awaitTermination()
    assert ingest.read_pairs(spark, out).count() == 2


def test_stream_looks_up_only_its_own_keys(spark, tmp_path):
    """Ten batches of equal size: the tenth reads as many rows as the first, however much has come before."""
    source, out = f"{tmp_path}/in", f"{tmp_path}/out"
    for i in range(10):
        rows = [reply(100 * i + j, 20 * i + j % 20) for j in range(40)] + [reply(100 * i + 50, max(i - 1, 0) * 20)]
        jsonl.append_jsonl(spark.createDataFrame(rows, ingest.REPLIES).coalesce(1), source)
    query = ingest.stream_ingest(spark, source, out, f"{tmp_path}/state", files_per_batch=1)
    query.awaitTermination()
    steps = [p for p in query.recentProgress if p.numInputRows]
    assert len(steps) == 10 and len({p.numInputRows for p in steps}) == 1
    assert [p.stateOperators[0].numRowsTotal for p in steps] == [20 * (i + 1) for i in range(10)]
    assert any("rocksdb" in k.lower() for k in steps[-1].stateOperators[0].customMetrics) and not (tmp_path / "out" / "keys").exists()
    got = ingest.read_pairs(spark, out).collect()
    # of a batch's equal pairs the first by task
    assert sorted((r.task_id, r.question) for r in got) == sorted((100 * i + j, f"q{20 * i + j}") for i in range(10) for j in range(20))


# values and pictures with what PostgreSQL's manual and its rules give for them
NUMBERS = [
    ("-0.1", "99.99", "  -.10"), ("-0.1", "FM9.99", "-.1"), ("0.1", "0.9", " 0.1"), ("12", "9990999.9", "    0012.0"), ("12", "FM9990999.9", "0012."),
    ("485", "999", " 485"), ("-485", "999", "-485"), ("1485", "9,999", " 1,485"), ("1485", "9G999", " 1,485"), ("148.5", "999.999", " 148.500"),
    ("148.5", "FM999.999", "148.5"), ("148.5", "FM999.990", "148.500"), ("148.5", "999D999", " 148.500"), ("3148.5", "9G999D999", " 3,148.500"),
    ("-485", "999S", "485-"), ("-485", "999MI", "485-"), ("485", "999MI", "485 "), ("485", "FM999MI", "485"), ("485", "PL999", "+ 485"),
    ("-485", "999PR", "<485>"), ("485", "RN", "        CDLXXXV"), ("485", "FMRN", "CDLXXXV"), ("5.2", "FMRN", "V"), ("482", "999th", " 482nd"),
    ("485", '"Good number:"999', "Good number: 485"), ("12", "99V999", " 12000"), ("12.4", "99V999", " 12400"), ("12.45", "99V9", " 125"),
    ("0.0004859", "9.99EEEE", " 4.86e-04"), ("-12345.678", "9.999EEEE", "-1.235e+04"), ("1234", "999", " ###"), ("-1234.5", "99.9", "-##.#"),
    ("0", "999", "   0"), ("0", "9.9", "  .0"), ("0.5", "9", " 1"), ("-0.001", "9.99", "  .00"), ("7", "S999", "  +7"), ("-7", "S999", "  -7"), ("4000", "FMRN", "#" * 15),
    ("1234567.891", "9,999,999.99", " 1,234,567.89"), ("12", "9,999", "    12"), ("12", "FM9,999", "12"), ("12", "0,999", " 0,012"), ("111", "FM999TH", "111TH"), ("9.995", "9.99", " #.##"),
]


def test_to_char_of_numbers(spark):
    df = spark.range(1)
    got = df.select(*[pg.to_char(F.lit(v).cast("decimal(20,7)"), p).alias(f"c{i}") for i, (v, p, _) in enumerate(NUMBERS)]).first()
    assert [(v, p, x) for (v, p, _), x in zip(NUMBERS, got, strict=True)] == NUMBERS
    assert tuple(df.select(*[pg.to_char(F.lit(None).cast("double"), p) for p in ("99.9", "RN", "9.9EEEE")]).first()) == (None, None, None)
    assert df.select(pg.to_char(F.lit(1.5), "9.9"), pg.to_char(F.lit(-7), "99")).first() == (" 1.5", " -7")


def test_mask_inside_structs_arrays_and_maps(spark):
    df = spark.sql("""SELECT named_struct('email', 'x@y.z', 'age', 7, 'note', cast(null AS string)) AS person, array('a', null, 'b') AS usernames,
        map('k', named_struct('birth_date', 'x')) AS more, array(array(1.5BD)) AS amounts, cast(null AS struct<a:string>) AS nothing""")
    r = mask(df, salt="s", **DECADE).first()
    assert r.person.email.endswith("@example.org") and r.person.age == 7 and r.person.note is None and r.nothing is None
    assert " " in r.usernames[0] and r.usernames[1] is None and r.usernames[0] != "a"
    assert list(r.more) == ["k"] and len(r.more["k"].birth_date) == 10 and r.amounts == [["1.5"]]
    flat = mask(df.select("person.email"), salt="s", **DECADE).first()
    assert flat.email == r.person.email
    hidden = mask(df, salt="s", strict=True, keys=("person.age",), rules={"person.note": "name"}, **DECADE).first()
    assert hidden.person.age != "7" and len(hidden.person.age) == 32 and len(hidden.amounts[0][0]) == 32
    with pytest.raises(ValueError, match="salt"):
        mask(df, strict=True)
