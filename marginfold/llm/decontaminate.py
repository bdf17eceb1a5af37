"""Benchmark passages in documents, found with a distributed positional inverted index.

The index holds a posting (term, document, position) for every occurrence of the rarest terms of the
benchmark, counted over all documents. Lists of a passage's two rarest terms, each shifted by the
term's offset in the passage, are intersected; a posting of a rarest term also has the words around
it, from which phrases are verified exactly, so that texts are never shuffled.

Words meet the benchmark's terms in a filter of fixed size (1 MB) before they are joined with them.
Without it, each word of the corpus would enter a shuffle as soon as the terms are too many to
broadcast; with it, only words that occur in the benchmark do, and about one in
``_FILTER_BITS / terms`` of the others. The join decides, so results don't depend on the filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marginfold.sources.scratch import written

WINDOW = 10
_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_FILTER_BITS = 1 << 23
_FILTER_PAGE = 512
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased and no other letter changed."""
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.coalesce(F.regexp_extract_all(lowered, F.lit(_WORDS), F.lit(0)), F.array().cast("array<string>"))


def _key(*columns: str) -> Column:
    return F.xxhash64(*columns)


def _items(benchmark: DataFrame) -> DataFrame:
    """(item, item_id, words, length) of the items with words; length is that of their windows."""
    words = benchmark.select("item_id", _words(F.col("text")).alias("words"))
    return (
        words.where(F.size("words") > 0)
        .withColumn("item", _key("item_id", "words"))
        .dropDuplicates(["item"])
        .withColumn("length", F.least(F.lit(WINDOW), F.size("words")))
    )


def _filter_of(terms: DataFrame) -> Column:
    """The fixed-size filter of a table's ``term`` column: an array of bit words, as a scalar subquery."""
    pages = _FILTER_BITS // 64 // _FILTER_PAGE
    bits = (
        terms.select(_filter_bit(F.col("term")).alias("bit"))
        .groupBy((F.col("bit") / F.lit(64)).cast("int").alias("slot"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("bits"))
    )
    entry = F.struct((F.col("slot") % _FILTER_PAGE).alias("key"), F.col("bits").alias("value"))
    paged = bits.groupBy((F.col("slot") / F.lit(_FILTER_PAGE)).cast("int").alias("page")).agg(
        F.map_from_entries(F.collect_list(entry)).alias("slots")
    )
    dense = F.transform(
        F.sequence(F.lit(0), F.lit(_FILTER_PAGE - 1)),
        lambda i: F.coalesce(F.try_element_at("slots", i), F.lit(0).cast("bigint")),
    )
    whole = paged.select("page", dense.alias("dense")).agg(
        F.map_from_entries(F.collect_list(F.struct("page", "dense"))).alias("pages")
    )
    blank = F.array_repeat(F.lit(0).cast("bigint"), _FILTER_PAGE)
    return whole.select(
        F.flatten(
            F.transform(
                F.sequence(F.lit(0), F.lit(pages - 1)), lambda i: F.coalesce(F.try_element_at("pages", i), blank)
            )
        )
    ).scalar()


def _filter_bit(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(_FILTER_BITS))


def _passes(word: Column, term_filter: Column) -> Column:
    """False only if the word is none of the filter's terms."""
    bit = _filter_bit(word)
    bits = F.get(term_filter, F.shiftright(bit, 6).cast("int"))
    return F.call_function("shiftrightunsigned", bits, (bit % 64).cast("int")).bitwiseAND(F.lit(1)) == 1


def split_words(docs: DataFrame) -> DataFrame:
    """(doc_id, doc, words, n_words) of every document, written to the shared folder; ``doc`` is a hash of id and text."""
    worded = docs.select("doc_id", _key("doc_id", "text").alias("doc"), _words(F.col("text")).alias("words"))
    return written(worded.withColumn("n_words", F.size("words").cast("bigint")))


def term_counts(worded: DataFrame, items: DataFrame) -> DataFrame:
    """(term, count) over all documents, for the terms of the items; words are counted before they shuffle."""
    terms = written(items.select(F.explode("words").alias("term")).distinct())
    occurring = worded.select(F.explode("words").alias("term")).where(_passes(F.col("term"), _filter_of(terms)))
    return occurring.groupBy("term").count().join(terms, "term")


def _rarest(items: DataFrame, counts: DataFrame) -> DataFrame:
    """(item, start, first_at, first, second_at, second) of every window all of whose terms occur.

    The positions and terms are those of the rarest term and the next rarest other term, or the same
    one if the window has no other.
    """
    windows = items.select(
        "item", "words", "length", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("length"))).alias("start")
    )
    placed = windows.select(
        "item", "start", "length",
        F.posexplode(F.slice("words", F.col("start") + 1, F.col("length"))).alias("offset", "term"),
    )
    ranked = (
        placed.join(counts, "term")
        .groupBy("item", "start", "length")
        .agg(F.array_sort(F.collect_list(F.struct("count", "term", (F.col("start") + F.col("offset")).alias("at")))).alias("ranked"))
        .where(F.size("ranked") == F.col("length"))
    )
    first = F.col("ranked")[0]
    other = F.filter("ranked", lambda r: r["term"] != F.col("ranked")[0]["term"])
    second = F.coalesce(F.get(other, F.lit(0)), first)
    return ranked.select(
        "item",
        "start",
        first["at"].alias("first_at"),
        first["term"].alias("first"),
        second["at"].alias("second_at"),
        second["term"].alias("second"),
    )


def build_index(worded: DataFrame, terms: DataFrame) -> DataFrame:
    """One row per posting of ``terms`` (term, is_first) in split documents, written to the shared folder.

    Columns: doc_id, doc, position, term, and around: the words up to nine before and after, for terms
    that are the rarest of a window.
    """
    placed = worded.select("doc_id", "doc", "words", F.posexplode("words").alias("position", "term"))
    start = F.greatest(F.col("position") - (WINDOW - 1), F.lit(0))
    around = F.slice("words", start + 1, F.col("position") - start + WINDOW)
    firsts = _filter_of(terms.where("is_first"))
    met = placed.where(_passes(F.col("term"), _filter_of(terms))).select(
        "doc_id", "doc", "position", "term", F.when(_passes(F.col("term"), firsts), around).alias("around")
    )
    found = met.join(terms, "term")
    return written(found.withColumn("around", F.when(F.col("is_first"), F.col("around"))).drop("is_first"))


def _candidates(index: DataFrame, rarest: DataFrame, items: DataFrame) -> DataFrame:
    """Postings of rarest terms whose document has the next rarest term at the fitting distance too.

    ``start`` is where the item would begin in the document: the lists are shifted by the offset of
    their term in the item, so equal starts meet.
    """
    firsts = rarest.select("item", "first_at", F.col("first").alias("term")).distinct()
    seconds = rarest.select("item", "second_at", F.col("second").alias("term")).distinct()
    first_lists = index.where("around IS NOT NULL").join(firsts, "term").select(
        "doc_id", "doc", "item", "position", "around", "first_at", (F.col("position") - F.col("first_at")).alias("start")
    )
    second_lists = index.join(seconds, "term").select(
        F.col("doc").alias("doc2"), F.col("item").alias("item2"), (F.col("position") - F.col("second_at")).alias("start2")
    )
    met = first_lists.join(
        second_lists,
        (F.col("doc") == F.col("doc2")) & (F.col("item") == F.col("item2")) & (F.col("start") == F.col("start2")),
        "left_semi",
    )
    return met.join(items.select("item", "item_id", F.col("words").alias("item_words"), "length"), "item")


def _run(step: int) -> Column:
    """How many words in a row, up to nine, are equal on one side of the posting."""
    at = F.least(F.col("position"), F.lit(WINDOW - 1))

    def grow(run: Column, t: Column) -> Column:
        here = F.get("around", at + step * t)
        there = F.get("item_words", F.col("first_at") + step * t)
        return F.when((run == t - 1) & (here == there), t).otherwise(run)

    return F.aggregate(F.sequence(F.lit(1), F.lit(WINDOW - 1)), F.lit(0), grow)


def _indexed(worded: DataFrame, benchmark: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    items = written(_items(benchmark))
    rarest = written(_rarest(items, written(term_counts(worded, items))))
    terms = (
        rarest.select(F.col("first").alias("term"), F.lit(True).alias("is_first"))
        .union(rarest.select("second", F.lit(False)))
        .groupBy("term")
        .agg(F.max("is_first").alias("is_first"))
    )
    return items, rarest, build_index(worded, written(terms))


def _exact(items: DataFrame, rarest: DataFrame, index: DataFrame) -> DataFrame:
    runs = _candidates(index, rarest, items).withColumns({"before": _run(-1), "after": _run(1)})
    return runs.where("before + after + 1 >= length").select(
        "doc_id",
        "doc",
        "item_id",
        (F.col("position") - F.col("before")).alias("first"),
        (F.col("position") + F.col("after")).alias("last"),
    )


def phrase_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, first, last): stretches of document words covered by exact windows of an item.

    Matches of one item may overlap; positions count words from 0.
    """
    return _exact(*_indexed(split_words(docs), benchmark)).drop("doc").distinct()


def proximity_matches(docs: DataFrame, benchmark: DataFrame, least_terms: int = 8) -> DataFrame:
    """(doc_id, item_id, position, n_terms): windows that occur loosely.

    ``position`` is that of the window's rarest term; at least ``least_terms`` of the window's different
    terms (all of a shorter window) are among the words up to nine before and after it, in any order.
    """
    items, rarest, index = _indexed(split_words(docs), benchmark)
    windows = rarest.join(items.select("item", "item_id", "words", "length"), "item").select(
        "item_id",
        F.col("first").alias("term"),
        F.array_distinct(F.slice("words", F.col("start") + 1, F.col("length"))).alias("terms"),
    )
    near = index.where("around IS NOT NULL").join(windows, "term")
    n_terms = F.size(F.array_intersect("terms", "around"))
    return (
        near.withColumn("n_terms", n_terms)
        .where(F.col("n_terms") >= F.least(F.lit(least_terms), F.size("terms")))
        .groupBy("doc_id", "item_id", "position")
        .agg(F.max("n_terms").alias("n_terms"))
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, doc, n_words, n_hit, n_items, items_sha256, contaminated.

    ``n_hit`` counts the words inside any occurrence of a window of ten consecutive item words (an item
    of fewer words is one window), ``n_items`` the items with such windows, whose ids, sorted as
    strings and joined by commas, make ``items_sha256``. ``doc`` is a hash of id and text. Null and
    empty texts have no words; items without words match nothing; an item with a null id marks words
    but is not counted. Rows that repeat id and text get equal results; other columns are ignored.
    """
    worded = split_words(docs)
    items, rarest, index = _indexed(worded, benchmark)
    hits = (
        _exact(items, rarest, index)
        .groupBy(F.col("doc").alias("hit_doc"), F.coalesce("doc_id", F.lit(-1)).alias("hit_id"))
        .agg(F.collect_set(F.struct("first", "last")).alias("spans"), F.collect_set("item_id").alias("ids"))
        .select(
            "hit_doc",
            "hit_id",
            F.size(
                F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["last"]))))
            ).alias("n_hit"),
            F.array_sort(F.transform("ids", lambda i: i.cast("string"))).alias("ids"),
        )
    )
    joined = worded.select("doc_id", "doc", "n_words").join(
        hits, (F.col("doc") == F.col("hit_doc")) & (F.coalesce("doc_id", F.lit(-1)) == F.col("hit_id")), "left"
    )
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("bigint")
    return joined.select(
        "doc_id",
        "doc",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns, that hold no window of the benchmark."""
    leaving = contamination(docs, benchmark).where("contaminated").select(F.col("doc").alias("__doc")).distinct()
    return docs.join(leaving, _key("doc_id", "text") == F.col("__doc"), "left_anti")
