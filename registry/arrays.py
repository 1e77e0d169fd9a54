"""Array queries over the words of part descriptions and over embeddings."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions import arrays
from millrace.operators import postings, search
from millrace.operators.ordered import chunked_pages
from millrace.session import fresh_path
from millrace.sources import series
from registry import query, table

_WORDS = "string_split(p_name || ' ' || p_type || ' ' || p_brand, ' ')"
_PARTS = f"(SELECT p_partkey, p_size, {_WORDS} AS words FROM part)"


def _parts(spark, d):
    words = F.split(F.concat_ws(" ", "p_name", "p_type", "p_brand"), " ")
    return table(spark, d, "part").select("p_partkey", "p_size", words.alias("words"))


def _text(array):
    return F.array_join(array, ",")


@query("array_subscript", f"""
SELECT p_partkey, words[1] AS first_word, CASE WHEN FALSE THEN '' END AS zeroth, words[9] AS ninth,
       CASE WHEN p_size % 6 = 0 THEN NULL ELSE words[p_size % 6] END AS picked
FROM {_PARTS}
""")
def array_subscript(spark, d):
    words = F.col("words")
    return _parts(spark, d).select(
        "p_partkey", arrays.element(words, 1).alias("first_word"), arrays.element(words, 0).alias("zeroth"),
        arrays.element(words, 9).alias("ninth"), arrays.element(words, F.col("p_size") % 6).alias("picked"),
    )


@query("array_slice", f"""
SELECT p_partkey, array_to_string(words[1:2], ',') AS first_two, array_to_string(words[1:1], ',') AS first_one,
       array_to_string(words[2:], ',') AS tail, array_to_string(words[1:len(words)-1], ',') AS but_last,
       array_to_string(CASE WHEN p_size % 5 = 0 THEN [] ELSE words[1:p_size % 5] END, ',') AS sized,
       CAST(len(words) AS INTEGER) AS size
FROM {_PARTS}
""")
def array_slice(spark, d):
    words = F.col("words")
    return _parts(spark, d).select(
        "p_partkey", _text(arrays.between(words, 1, 2)).alias("first_two"),
        _text(arrays.between(words, 1, 1)).alias("first_one"), _text(arrays.between(words, 2)).alias("tail"),
        _text(arrays.drop_last(words)).alias("but_last"),
        _text(arrays.between(words, 1, F.col("p_size") % 5)).alias("sized"), arrays.length(words).alias("size"),
    )


@query("array_search", f"""
SELECT p_partkey, list_contains(words, 'red') AS has_red, words[1] = 'red' AS starts_red
FROM {_PARTS} WHERE list_contains(words, 'red') OR words[2] = 'widget'
""")
def array_search(spark, d):
    words = F.col("words")
    kept = _parts(spark, d).where(arrays.has(words, "red") | (arrays.element(words, 2) == "widget"))
    return kept.select("p_partkey", arrays.has(words, "red").alias("has_red"),
                       (arrays.element(words, 1) == "red").alias("starts_red"))


@query("array_overlap", f"""
SELECT p_partkey FROM {_PARTS} WHERE list_has_any(words, ['red', 'bolt'])
""")
def array_overlap(spark, d):
    return _parts(spark, d).where(arrays.overlaps(F.col("words"), F.array(F.lit("red"), F.lit("bolt")))).select("p_partkey")


@query("array_contains", f"""
SELECT p_partkey, list_has_all(words, ['red', 'bolt']) AS holds, list_has_all(['red', 'bolt', 'small'], words[1:2]) AS held
FROM {_PARTS}
""")
def array_contains(spark, d):
    words = F.col("words")
    pair = F.array(F.lit("red"), F.lit("bolt"))
    wide = F.array(F.lit("red"), F.lit("bolt"), F.lit("small"))
    return _parts(spark, d).select(
        "p_partkey", arrays.contains_all(words, pair).alias("holds"),
        arrays.contained_by(arrays.between(words, 1, 2), wide).alias("held"),
    )


@query("array_update", f"""
SELECT p_partkey, words[1] || ',suspense,' || array_to_string(words[3:], ',') AS one_set,
       CASE WHEN p_size = 1 THEN 'documentary,thriller,action' ELSE array_to_string(words, ',') END AS all_set,
       array_to_string(list_append(words, CAST(p_size AS VARCHAR)), ',') AS longer,
       array_to_string(list_concat(words, ['x', 'y']), ',') AS joined
FROM {_PARTS}
""")
def array_update(spark, d):
    words = F.col("words")
    new = F.array(*[F.lit(w) for w in ("documentary", "thriller", "action")])
    return _parts(spark, d).select(
        "p_partkey", _text(arrays.replace_at(words, 2, "suspense")).alias("one_set"),
        _text(F.when(F.col("p_size") == 1, new).otherwise(words)).alias("all_set"),
        _text(arrays.append(words, F.col("p_size").cast("string"))).alias("longer"),
        _text(F.concat(words, F.array(F.lit("x"), F.lit("y")))).alias("joined"),
    )


@query("array_unnest", f"""
SELECT p_partkey, n AS place, words[n] AS word FROM (SELECT p_partkey, words, unnest(generate_series(1, len(words))) AS n FROM {_PARTS})
""")
def array_unnest(spark, d):
    return arrays.unnest(_parts(spark, d), "words", "word", "place").select("p_partkey", "place", "word")


@query("array_zip_rows", """
SELECT label, CAST(place AS INTEGER) AS place, count(*) AS n, CAST(sum(CAST(CAST(a AS DOUBLE) AS DECIMAL(18,4))) AS DOUBLE) AS sum_a,
       count(b) AS n_b, CAST(sum(CAST(CAST(b AS DOUBLE) AS DECIMAL(18,4))) AS DOUBLE) AS sum_b
FROM (SELECT label, n AS place, embedding[n] AS a, embedding[n + 1] AS b
      FROM (SELECT label, embedding, unnest(generate_series(1, len(embedding))) AS n FROM embeddings))
GROUP BY 1, 2
""")
def array_zip_rows(spark, d):
    """An array next to the same array without its first element, as rows."""
    vectors = table(spark, d, "embeddings").select("label", "embedding")
    places = F.sequence(F.lit(1), F.size("embedding"))
    rows = arrays.zip_rows(
        vectors, {"place": places, "a": F.col("embedding"), "b": arrays.between(F.col("embedding"), 2)}, ["label"]
    )

    def total(name):
        return F.sum(F.col(name).cast("double").cast("decimal(18,4)")).cast("double").alias(f"sum_{name}")

    return rows.groupBy("label", "place").agg(F.count("*").alias("n"), total("a"), F.count("b").alias("n_b"), total("b"))


@query("series_in_step", """
SELECT l_linenumber, count(*) AS n, count(a) AS n_a, CAST(sum(a) AS BIGINT) AS sum_a, count(b) AS n_b, CAST(sum(b) AS BIGINT) AS sum_b
FROM (SELECT l_linenumber, CASE WHEN i <= l_linenumber THEN i END AS a, CASE WHEN i <= l_quantity THEN i * 2 END AS b
      FROM (SELECT l_linenumber, l_quantity, unnest(generate_series(1, greatest(l_linenumber, CAST(l_quantity AS INTEGER)))) AS i
            FROM lineitem))
GROUP BY 1
""")
def series_in_step(spark, d):
    rows = table(spark, d, "lineitem").select("l_linenumber", "l_quantity")
    a = F.sequence(F.lit(1), F.col("l_linenumber"))
    b = F.sequence(F.lit(2), F.col("l_quantity").cast("int") * 2, F.lit(2))
    wide = series.expand_in_step(rows, {"a": a, "b": b})
    return wide.groupBy("l_linenumber").agg(
        F.count("*").alias("n"), F.count("a").alias("n_a"), F.sum("a").alias("sum_a"), F.count("b").alias("n_b"),
        F.sum("b").alias("sum_b"),
    )


@query("array_inverted_lookup", f"""
SELECT p_partkey AS id FROM {_PARTS} WHERE list_has_all(words, ['red', 'bolt'])
""")
def array_inverted_lookup(spark, d):
    """Parts with two words, by an index of words that is stored in two loads and read again."""
    root, parts = fresh_path(spark, "words"), _parts(spark, d)
    for load in (0, 1):
        postings.add_load(search.element_index(parts.where(F.col("p_partkey") % 2 == load), "words", "p_partkey"), root, load)
    return postings.ids_with_all(postings.postings(spark, root), ["red", "bolt"])


@query("array_element_counts", """
SELECT word, count(*) AS documents FROM (
  SELECT DISTINCT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word
""")
def array_element_counts(spark, d):
    words = table(spark, d, "documents").select("doc_id", F.split("text", " ").alias("words"))
    index = search.element_index(words, "words", "doc_id")
    return index.groupBy(F.col("term").alias("word")).agg(F.count("*").alias("documents"))


@query("chunk_arrays", """
SELECT (rn - 1) // 1000 AS page, count(*) AS rows_in, min(event_id) AS first_id,
       string_agg(user_id, ',' ORDER BY rn) AS users
FROM (SELECT event_id, user_id, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events) GROUP BY 1
""")
def chunk_arrays(spark, d):
    rows = table(spark, d, "events").select("ts", "event_id", "user_id")
    pages = chunked_pages(rows, ["ts", "event_id"], 1000, ["event_id", "user_id"])
    return pages.select("page", F.size("event_id").cast("bigint").alias("rows_in"), F.array_min("event_id").alias("first_id"),
                        _text(F.col("user_id").cast("array<string>")).alias("users"))


@query("array_rectangular", """
SELECT p_partkey, p_size % 3 > 0 AS even_rows, CASE WHEN p_size % 3 > 0 THEN p_size * 2 END AS corner FROM part
""")
def array_rectangular(spark, d):
    """Two-row arrays, every third one ragged; only even ones are taken as matrices."""
    size = F.col("p_size").cast("int")
    long_ = F.array(F.lit(1), F.lit(2), F.lit(3))
    second = F.when(size % 3 > 0, F.array(size, size * 2)).otherwise(long_)
    rows = table(spark, d, "part").select("p_partkey", F.array(F.array(size, F.lit(0)), second).alias("m"))
    checked = rows.withColumn("even_rows", arrays.is_rectangular(F.col("m")))
    matrix = F.when(F.col("even_rows"), arrays.rectangular(F.col("m")))
    return checked.select("p_partkey", "even_rows", F.get(F.get(matrix, F.lit(1)), F.lit(1)).alias("corner"))
