"""Benchmark decontamination with a distributed positional index; DataFrame operations only.

Documents are stored once as token lists (a token's place in its list is its position). The frequency of each test term is counted
over all of them. Every window of a test item (ten consecutive words; a shorter item is one window) then names its two rarest
places; only for the terms at such places are posting lists made: (term, document, position). A posting of the term at place p of an
item gives the diagonal position - p; the lists of a window's two rarest terms are intersected by grouping on (document, item,
diagonal). What is left are the places where the whole window can stand, and there it is compared word by word with the stored
tokens. A window with a term that no document holds is dropped before any list is made.

Words: A-Z lowered, runs of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`. Posting lists of a hot passage are rows, not groups: a group is one
item's places on one diagonal of one document, at most the item's length. Candidate places and test terms are broadcast only after
they were counted and found small.

Defined results: null or empty text has no words and no hit; an item without words matches nothing. Equal item texts are one set of
windows told for each of their ids; a null item_id is told as the empty text and counts as an item. A document is known by doc_id
and a hash of its text: repeated rows get equal results, rows that share only the id do not mix. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyline.llm.store import small_or_not, written

LENGTH = 10
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: str) -> Column:
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(lowered, _SEPARATORS), lambda w: w != "")


def text_key() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")), F.length("text")).alias("text_key")


def token_store(documents: DataFrame) -> DataFrame:
    """Tokens of every document in order, written to the shared folder."""
    return written(documents.select("doc_id", text_key(), words("text").alias("words")), "tokens")


def item_windows(benchmark: DataFrame, length: int = LENGTH) -> tuple[DataFrame, DataFrame]:
    """(items, windows): item (hash of the words) with its ids; one row per window with its place, words and size."""
    told = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words("text").alias("words"))
    told = told.where(F.size("words") > 0).withColumn("item", F.md5(F.array_join("words", " ")))
    items = told.select("item", "item_id").distinct()
    last = F.greatest(F.lit(0), F.size("words") - length)
    windows = told.dropDuplicates(["item"]).select("item", "words", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    window = F.slice("words", F.col("at") + 1, F.lit(length))
    return items, windows.select("item", "at", window.alias("window"), F.size(window).alias("n"))


def term_counts(tokens: DataFrame, windows: DataFrame) -> DataFrame:
    """(term, n): how often each test term stands in the documents."""
    terms = windows.select(F.explode("window").alias("term")).distinct()
    places = tokens.select(F.explode("words").alias("term"))
    return places.join(small_or_not(terms), "term").groupBy("term").agg(F.count("*").alias("n"))


def rarest_places(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Windows all of whose terms occur, with `need`: the places (in the item) of their two rarest terms, rarest first."""
    placed = windows.select("item", "at", F.posexplode("window").alias("k", "term"))
    placed = placed.join(counts.withColumnRenamed("n", "df"), "term")
    ranked = placed.groupBy("item", "at").agg(
        F.count("*").alias("known"), F.slice(F.sort_array(F.collect_list(F.struct("df", "k"))), 1, 2).alias("rare")
    )
    need = F.transform("rare", lambda x: x["k"] + F.col("at"))
    return windows.join(ranked, ["item", "at"]).where("known = n").select("item", "at", "n", "window", need.alias("need"))


def postings(tokens: DataFrame, windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(anchors, lists): anchors are (term, item, place, least) with the fewest places a window of the item needs; lists are
    (doc_id, text_key, term, position) for the anchors' terms."""
    least = windows.groupBy("item").agg(F.min(F.size("need")).alias("least"))
    anchors = windows.select("item", F.explode("need").alias("place"), F.col("window"), "at")
    anchors = anchors.select("item", "place", F.element_at("window", F.col("place") - F.col("at") + 1).alias("term")).distinct()
    # written before it is counted and broadcast, whole and as terms
    anchors = written(anchors.join(least, "item"), "anchors")
    terms = small_or_not(anchors.select("term").distinct())
    lists = tokens.select("doc_id", "text_key", F.posexplode("words").alias("position", "term")).join(terms, "term")
    return anchors, lists


def phrase_matches(documents_tokens: DataFrame, windows: DataFrame) -> DataFrame:
    """Every place where a window stands: (doc_id, text_key, item, at, start, n)."""
    anchors, lists = postings(documents_tokens, windows)
    on_line = lists.join(small_or_not(anchors), "term").select(
        "doc_id", "text_key", "item", "least", "place", (F.col("position") - F.col("place")).alias("diagonal")
    )
    met = on_line.groupBy("doc_id", "text_key", "item", "diagonal").agg(F.collect_set("place").alias("places"), F.max("least").alias("least"))
    met = met.where(F.size("places") >= F.col("least")).drop("least")
    by_item = windows.groupBy("item").agg(F.collect_list(F.struct("at", "n", "need", "window")).alias("windows"))
    able = F.filter("windows", lambda x: F.size(F.array_except(x["need"], F.col("places"))) == 0)
    candidates = met.join(by_item, "item").select("doc_id", "text_key", "item", "diagonal", F.inline(able))
    candidates = candidates.select(
        F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "item", "at", (F.col("diagonal") + F.col("at")).alias("start"), "n"
    ).where("start >= 0")
    candidates = written(candidates, "candidates")
    # only documents with candidates are moved; what is broadcast is two numbers for each of them
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k"))
    touched = documents_tokens.join(small_or_not(candidates.select("d", "k").distinct()), same, "left_semi")
    found = touched.join(candidates, same).select(
        "doc_id", "text_key", "item", "at", "start", "n", F.slice("words", F.col("start") + 1, F.col("n")).alias("there")
    )
    found = found.join(windows.select("item", "at", "window"), ["item", "at"]).where("there = window")
    return found.select("doc_id", "text_key", "item", "at", "start", "n")


def proximity_matches(documents_tokens: DataFrame, windows: DataFrame, slop: int) -> DataFrame:
    """Windows whose two rarest terms stand within `slop` words of their distance in the window: (doc_id, text_key, item, at, start,
    shift), start being where the window would begin by its rarest term. One-word windows are phrase matches and not told here."""
    anchors, lists = postings(documents_tokens, windows)
    pairs = windows.where(F.size("need") == 2).select("item", "at", F.col("need")[0].alias("p"), F.col("need")[1].alias("q"))
    line = lists.join(small_or_not(anchors.drop("least")), "term")
    line = line.select("doc_id", "text_key", "item", "place", (F.col("position") - F.col("place")).alias("diagonal"))
    step = slop + 1
    first = line.join(pairs.withColumnRenamed("p", "place"), ["item", "place"])
    first = first.withColumn("band", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda x: x + F.floor(F.col("diagonal") / step))))
    second = line.select(
        F.col("doc_id").alias("d"), F.col("text_key").alias("k"), F.col("item").alias("i"), F.col("place").alias("q2"),
        F.col("diagonal").alias("other"), F.floor(F.col("diagonal") / step).alias("b"),
    )
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")) & (F.col("item") == F.col("i"))
    met = first.join(second, same & (F.col("q") == F.col("q2")) & (F.col("band") == F.col("b")))
    shift = (F.col("other") - F.col("diagonal")).alias("shift")
    met = met.where(F.abs(F.col("other") - F.col("diagonal")) <= slop)
    return met.select("doc_id", "text_key", "item", "at", (F.col("diagonal") + F.col("at")).alias("start"), shift)


def contamination(documents: DataFrame, benchmark: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per input row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    tokens = token_store(documents)
    items, windows = item_windows(benchmark, length)
    windows = written(windows, "windows")
    windows = written(rarest_places(windows, term_counts(tokens, windows)), "windows")
    found = written(phrase_matches(tokens, windows).distinct(), "matches")
    key = ["doc_id", "text_key"]
    hit = found.select(*key, F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("position")).distinct()
    hit = hit.groupBy(*key).agg(F.count("*").alias("n_hit"))
    told = found.select(*key, "item").distinct().join(items, "item").select(*key, "item_id").distinct()
    told = told.groupBy(*key).agg(F.array_sort(F.collect_list("item_id")).alias("ids"))
    both = hit.join(told.withColumnsRenamed({"doc_id": "d", "text_key": "k"}), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")))
    both = both.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "n_hit", "ids")
    rows = tokens.select("doc_id", "text_key", F.size("words").cast("long").alias("n_words"))
    out = rows.join(both, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "text_key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, without those that hold a window of a test item."""
    dirty = contamination(documents, benchmark).where("contaminated").select(F.col("doc_id").alias("d"), F.col("text_key").alias("k")).distinct()
    dirty = small_or_not(written(dirty, "contaminated"))
    rows = documents.select(F.struct("*").alias("row"), F.col("doc_id").alias("i"), text_key())
    kept = rows.join(dirty, F.col("i").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left_anti")
    return kept.select(*[F.col("row")[c].alias(c) for c in documents.columns])


def oracle(length: int = LENGTH) -> str:
    """The same in SQL, by joining all windows of the documents with those of the items."""
    tokens = "regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')".format(_UPPER, _LOWER)
    return f"""
WITH d AS (SELECT doc_id, {tokens} AS w FROM documents),
b AS (SELECT item_id, {tokens} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, array_to_string(w[i + 1 : i + {length}], ' ') AS g, least(len(w), {length}) AS n
       FROM (SELECT *, unnest(range(greatest(len(w) - {length}, 0) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i + 1 : i + n], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, i, n FROM dw JOIN bw USING (g, n)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
      FROM m GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""
