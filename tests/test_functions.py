import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from millrace.functions import arrays, dates, docs, rand, ranges, waves
from millrace.functions import text as tx


def one(spark, column, **values):
    df = spark.range(1).select(*[v.alias(k) for k, v in values.items()]) if values else spark.range(1)
    return df.select(column.alias("out")).first()["out"]


def words(*items):
    return F.array(*[F.lit(i) for i in items])


def test_array_subscripts_and_slices(spark):
    a = words("documentary", "thriller", "action")
    assert one(spark, arrays.element(a, 1)) == "documentary"
    assert one(spark, arrays.element(a, 0)) is None
    assert one(spark, arrays.element(a, 4)) is None
    assert one(spark, arrays.between(a, 1, 2)) == ["documentary", "thriller"]
    assert one(spark, arrays.between(a, 2)) == ["thriller", "action"]
    assert one(spark, arrays.between(a, 0, 9)) == ["documentary", "thriller", "action"]
    assert one(spark, arrays.between(a, 3, 1)) == []
    assert one(spark, arrays.drop_last(a)) == ["documentary", "thriller"]
    assert one(spark, arrays.replace_at(a, 2, "suspense")) == ["documentary", "suspense", "action"]


def test_array_sizes(spark):
    empty = F.array().cast("array<string>")
    assert one(spark, arrays.length(empty)) is None
    assert one(spark, arrays.cardinality(empty)) == 0
    assert one(spark, arrays.length(words("a", "b"))) == 2


def test_array_set_tests(spark):
    film = words("documentary", "suspense", "action")
    assert one(spark, arrays.contains_all(film, words("suspense")))
    assert not one(spark, arrays.contained_by(film, words("suspense")))
    assert one(spark, arrays.contained_by(film, words("suspense", "documentary", "action")))
    assert one(spark, arrays.overlaps(film, words("suspense", "x")))


def test_ragged_matrix_is_an_error(spark):
    good = F.array(F.array(F.lit(1), F.lit(2)), F.array(F.lit(3), F.lit(4)))
    assert one(spark, arrays.rectangular(good)) == [[1, 2], [3, 4]]
    with pytest.raises(PySparkException):
        one(spark, arrays.rectangular(F.array(F.array(F.lit(1)), F.array(F.lit(3), F.lit(4)))))


def test_zip_rows_pads_with_null(spark, as_rows):
    df = arrays.zip_rows(spark.range(1), {"i": F.array(F.lit(3), F.lit(4)), "t": words("a", "b", "c")})
    assert as_rows(df) == [(3, "a"), (4, "b"), (None, "c")]


def test_unnest_skips_empty_and_null(spark, as_rows):
    df = spark.createDataFrame([(1, ["x", "y"]), (2, []), (3, None)], "id int, a array<string>")
    assert as_rows(arrays.unnest(df, "a", "v", "n"), "id", "n", "v") == [(1, 1, "x"), (1, 2, "y")]


def test_text_helpers(spark):
    assert one(spark, tx.match_groups(F.lit("move 3 from 1 to 2"), tx.MOVE_PATTERN, 3)) == ["3", "1", "2"]
    assert one(spark, tx.match_groups(F.lit("[A] [B]"), tx.MOVE_PATTERN, 3)) is None
    assert one(spark, tx.ngrams(F.lit("Vivi"))) == ["Viv", "ivi"]
    assert one(spark, tx.ngrams(F.lit("aaaa"))) == ["aaa"]
    assert one(spark, tx.ngrams(F.lit("ab"))) == []
    assert one(spark, tx.split_literal(F.lit("a:b|c"), "|")) == ["a:b", "c"]
    assert one(spark, tx.split_literal(F.lit("abc"), ":")) == ["abc"]
    assert one(spark, tx.chars(F.lit("a🟩b"))) == ["a", "🟩", "b"]
    assert one(spark, tx.chars(F.lit(""))) == []
    assert one(spark, tx.first_half(F.lit("abcde"))) == "ab"
    assert one(spark, tx.second_half(F.lit("abcde"))) == "cde"
    assert [one(spark, tx.priority(F.lit(c))) for c in "azAZ."] == [1, 26, 27, 52, 0]
    assert one(spark, tx.strip_right(F.lit("1, 2, "), ", ")) == "1, 2"


@pytest.mark.parametrize("size, shown", [
    (0, "0 bytes"), (10239, "10239 bytes"), (10240, "10 kB"), (1024 * 1024, "1024 kB"), (10 * 1024 * 1024, "10 MB"),
    (8192 * 1500, "12 MB"), (20 * 1024**3, "20 GB"), (15 * 1024**4, "15 TB"), (10485247, "10239 kB"),
])
def test_pretty_bytes(spark, size, shown):
    assert one(spark, tx.pretty_bytes(F.lit(size).cast("bigint"))) == shown


def test_ranges(spark):
    def r(text):
        return ranges.parse(F.lit(text))

    assert one(spark, ranges.nested(r("2-8"), r("3-7")))
    assert not one(spark, ranges.nested(r("2-4"), r("6-8")))
    assert one(spark, ranges.nested(r("6-6"), r("4-6")))
    assert one(spark, ranges.lower(r("2-8"))) == 2
    with pytest.raises(PySparkException):
        one(spark, r("8-2"))


def test_json_and_xml(spark, as_rows):
    df = spark.createDataFrame([('{"a":1, "b":2,"c":{"c1":10,"c2":11}}',)], "j string")
    assert as_rows(docs.json_entries(df, "j"), "key", "value") == [("a", "1"), ("b", "2"), ("c", '{"c1":10,"c2":11}')]
    body = docs.xml_envelope(F.array(docs.xml_row("OrderID", F.lit("a<b&c"))))
    assert one(spark, body) == "<data><row><OrderID>a&lt;b&amp;c</OrderID></row></data>"
    good = docs.parse_envelope(F.lit("<data><row><OrderID>7</OrderID></row><row><OrderID>9</OrderID></row></data>"), "OrderID")
    assert [r["OrderID"] for r in one(spark, good["row"])] == [7, 9]
    bad = docs.parse_envelope(F.lit("<data><row><OrderID>badorder</OrderID></row></data>"), "OrderID")
    assert one(spark, bad[docs.CORRUPT]) is not None


def test_random_values_do_not_depend_on_partitioning(spark, as_rows):
    def draw(df):
        u = rand.uniform(5, F.col("id"))
        return df.select("id", rand.random_between(u, 3, 100, 4).alias("cpu"),
                         rand.random_text(5, F.col("id"), lo=2, hi=10).alias("note"),
                         rand.random_json(5, F.col("id")).alias("j"))

    base = spark.range(500)
    assert as_rows(draw(base.repartition(1))) == as_rows(draw(base.repartition(7)))
    out = draw(base).agg(F.min("cpu"), F.max("cpu"), F.max(F.length("note")), F.count("j"), F.count_if(F.col("note") == "")).first()
    assert 3 <= out[0] < 10 and 93 < out[1] <= 100 and out[2] <= 9 and 0 < out[3] < 500 and 0 < out[4] < 500


def test_waves_and_dates(spark):
    assert one(spark, waves.counter_reset(F.lit(10))) == 10
    assert one(spark, waves.counter_reset(F.lit(11))) == 1
    assert one(spark, waves.cosine_wave(F.lit(1), 30, amplitude=10, offset=5)) == 15.0
    ts = dates.as_ntz("2024-03-19 00:25:30")
    assert one(spark, dates.year_month(ts)) == "24-03"
    assert one(spark, dates.bucket_start(ts, 1200)) == dt.datetime(2024, 3, 19, 0, 20)
    assert one(spark, dates.before(ts, 90)) == dt.datetime(2024, 3, 19, 0, 24)
    assert one(spark, dates.epoch_seconds_between(ts, dates.before(ts, 1.5))) == 1.5


def test_sql_functions_agree_with_the_column_helpers(spark, as_rows):
    from millrace.functions import sql

    sql.register(spark)
    row = spark.sql("""
        SELECT array_item(array('a', 'b'), 0) AS none, array_item(array('a', 'b'), 2) AS b,
               array_between(array('a', 'b', 'c'), 2, 9) AS tail, first_match('x=1', '(\\\\w)=') AS k, first_match('x', '=') AS miss,
               random_between(uniform_of(1, 'r'), 3, 100, 2) AS r2, random_between(uniform_of(1, 'r'), 3, 100) AS r0,
               length(random_text(1, 'r', 12)) AS size, item_priority('Z') AS p
    """).first()
    assert (row["none"], row["b"], row["tail"], row["k"], row["miss"]) == (None, "b", ["b", "c"], "x", None)
    assert 3 <= row["r0"] <= row["r2"] < 100 and row["size"] == 12 and row["p"] == 52
    assert as_rows(spark.sql("SELECT * FROM generate_trigrams('Vivi')")) == [("Viv",), ("ivi",)]
    assert as_rows(spark.sql("SELECT * FROM split_rows('a\\r\\nb\\nc')")) == [(1, "a"), (2, "b"), (3, "c")]


def test_every_symbol_of_bulk_texts_has_its_own_hash(spark):
    import hashlib

    from millrace.plans import sampledata

    def u(*keys):
        return int(hashlib.md5("|".join(map(str, (3, *keys))).encode()).hexdigest()[:13], 16) / 2**52

    names = ["é" * 4, "", "k" * 47, "k" * 52, "k" * 55, "k" * 120, *map(str, range(300))]
    out = sampledata.bulk_rows(spark.createDataFrame([(n,) for n in names], "k string"), ["k"], seed=3, portable=True)
    for row in out.select("k", "val8", "val9").collect():
        for label, hi, got in (("t8", 25, row.val8), ("t9", 50, row.val9)):
            size = int(u(row.k, label) * (hi - 1) + 1)
            assert got == "".join(rand.SYMBOLS[int(u(row.k, label, i) * len(rand.SYMBOLS))] for i in range(1, size + 1)), (row, label)
