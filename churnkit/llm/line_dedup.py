"""Line deduplication by a deletion-neighbourhood join, in DataFrame functions only.

Edits are counted in words: two lines are near if one word inserted, deleted
or replaced makes them equal.  A near or equal line that stands earlier (by
document id, then by the hash of the text where rows repeat an id, then by line
number) makes a line go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnkit.llm.common import Scratch


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """``(doc_id, pos, line, n, h, m)`` of every line that isn't empty and has enough words; numbers start at 0, words end at a space."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "raw")).select(
        "doc_id", "pos", F.trim("raw").alias("line"))
    n = F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "), F.lit(""))) + 1
    return lines.withColumn("n", n).where((F.col("n") >= min_words) & (F.col("line") != "")).select(
        "doc_id", "pos", "line", "n", F.xxhash64("line").alias("h"), F.hash("line").alias("m"))


def _words(line: Column) -> Column:
    return F.split(line, " ")


def _half_keys(lines: DataFrame) -> DataFrame:
    """``(key, h)``: hashes of each line's first and last words, half of them and one fewer.

    Of two lines of n and at most n + 1 words that are near, one edited word
    leaves the first n // 2 words or the last n // 2 alike, and both lines
    emit that length."""
    half = F.floor(F.col("n") / 2).cast("int")
    keys = [F.xxhash64(F.lit(side), q, F.call_function("substring_index", F.col("line"), F.lit(" "), q * side))
            for side in (1, -1) for q in (half, half - 1)]
    return lines.select("h", F.explode(F.array(*keys)).alias("key"))


def _near(a: Column, b: Column) -> Column:
    """Whether two word arrays differ by one edit at most: what they share in front and behind covers the longer one
    but for one word."""
    n = F.greatest(F.size(a), F.size(b))

    def shared(x: Column, y: Column) -> Column:
        differs = F.array_position(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), False)
        return F.when(differs == 0, n).otherwise(differs - 1)

    front, back = shared(a, b), shared(F.reverse(a), F.reverse(b))
    return (F.abs(F.size(a) - F.size(b)) <= 1) & (front + back >= n - 1)


def near_lines(docs: DataFrame, scratch: Scratch, first: DataFrame, min_words: int) -> DataFrame:
    """``(h, m)`` of the distinct lines that have a near line before them.

    A line none of whose halves another line has is near to none and done
    with.  The others emit a hashed key for each deletion of one word, with
    the place of the deletion, and one for the whole line: lines equal but for
    the word at one place share a key, and a line without one word has
    another line's whole.  Only the earliest line of a key counts, so a key
    shared by many lines costs a partially aggregated minimum, never pairs.
    The earliest line found is compared word by word, which guards against
    equal hashes.  All sides of the joins grow with the corpus, so none is
    broadcast: one plan at every size."""
    keys = scratch.keep(_half_keys(_lines(docs, min_words)), "halves")
    shared = keys.groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("key")
    met = scratch.keep(keys.join(shared.hint("merge"), "key", "left_semi").select("h").distinct(), "met")
    scratch.drop("halves")
    scratch.release()

    place = met.join(first, "h").select("h", "m", "doc_id", "pos")
    wanted = place.groupBy("doc_id").agg(F.collect_list(F.struct("h", "m", "pos")).alias("wanted"))  # one document's lines
    texts = docs.join(wanted.hint("merge"), "doc_id").select("doc_id", F.split("text", "\n").alias("lines"), F.explode("wanted").alias("w"))
    found = texts.select("w.h", "w.m", "doc_id", "w.pos", F.trim(F.element_at("lines", F.col("w.pos") + 1)).alias("line"))
    same = (F.xxhash64("line") == F.col("h")) & (F.hash("line") == F.col("m"))  # texts of equal hashes may differ
    lines = scratch.keep(found.where(same).dropDuplicates(["h", "m"]), "lines")
    scratch.release()

    variants = scratch.keep(_deletions(lines), "variants")
    common = variants.groupBy("key").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo <> hi").select("key")
    live = scratch.keep(variants.join(common.hint("merge"), "key", "left_semi").join(
        lines.select("h", "m", F.struct("doc_id", "pos", "h", "m").alias("at")), ["h", "m"]).select("key", "place", "at"), "live")
    scratch.drop("variants")
    return _verified(_earliest(live), lines)


def _verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """``(h, m)`` of the lines ``at`` that are near to their ``first``."""
    text = lines.select(F.struct("doc_id", "pos", "h", "m").alias("at"), _words(F.col("line")).alias("words"))
    both = pairs.select("at", "first").join(text.toDF("at", "a"), "at").join(text.toDF("first", "b"), "first")
    return both.where(_near(F.col("a"), F.col("b"))).select("at.h", "at.m").distinct()


def _deletions(lines: DataFrame) -> DataFrame:
    """``(key, place, h, m)``: each line's words as a whole (place null) and less the word at each place.

    A key is the number of words and the XOR of their hashes, each taken with
    its place; behind a deletion places move up.  Running XORs make this
    linear in a line's words, however many it has."""
    each = lines.select("h", "m", F.posexplode(_words(F.col("line"))).alias("place", "word"))
    each = each.select("h", "m", "place", F.xxhash64("word", "place").alias("x"), F.xxhash64("word", F.col("place") - 1).alias("y"))
    own = Window.partitionBy("h", "m")
    so_far = own.orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.select("h", "m", "place", "x", "y", F.bit_xor("x").over(so_far).alias("rx"), F.bit_xor("y").over(so_far).alias("ry"),
                       F.bit_xor("x").over(own).alias("tx"), F.bit_xor("y").over(own).alias("ty"), F.count("*").over(own).alias("n"))
    cut = F.struct(F.xxhash64(F.expr("rx ^ x ^ ty ^ ry"), F.col("n") - 1).alias("key"), F.col("place").alias("place"))
    whole = F.struct(F.xxhash64("tx", "n").alias("key"), F.lit(None).cast("int").alias("place"))
    rows = F.when(F.col("place") == 0, F.array(cut, whole)).otherwise(F.array(cut))
    return each.select("h", "m", F.explode(rows).alias("r")).select("r.key", "r.place", "h", "m")


def _earliest(live: DataFrame) -> DataFrame:
    """``(at, first)``: each line with the earliest lines that have its key by the same place, or whole where it is cut,
    or cut where it is whole."""
    cut, whole = live.where("place IS NOT NULL"), live.where("place IS NULL")
    by_place = cut.groupBy("key", "place").agg(F.min("at").alias("first"))
    replaced = cut.join(by_place, ["key", "place"])
    longer = whole.join(by_place.groupBy("key").agg(F.min("first").alias("first")), "key")
    shorter = cut.join(whole.groupBy("key").agg(F.min("at").alias("first")), "key")
    pairs = [x.where("at > first").select("at", "first") for x in (replaced, longer, shorter)]
    return pairs[0].union(pairs[1]).union(pairs[2]).distinct()


def _document(id_col: str, text_col: str) -> Column:
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("t"))


def dropped_lines(df: DataFrame, scratch: Scratch, min_words: int = 8, id_col: str = "doc_id",
                  text_col: str = "text", short: bool = False) -> DataFrame:
    """``(doc_id, dropped)``: for each document that loses lines, their numbers in order; a document is an id and a text
    (``doc_id`` holds the id and the text's hash), so rows of one id with other texts have lines of their own.

    Lines of fewer than ``min_words`` words go with ``short`` only, and only
    where an equal line stands earlier.  Empty lines always stay, as does
    every line of a null text or a document with a null id."""
    docs = df.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        _document(id_col, text_col).alias("doc_id"), F.col(text_col).alias("text"))
    lines = _lines(docs, 1 if short else min_words).select("h", "m", "doc_id", "pos")
    seen = lines.groupBy("h", "m").agg(F.min(F.struct("doc_id", "pos")).alias("first"),
                                       (F.min(F.struct("doc_id", "pos")) != F.max(F.struct("doc_id", "pos"))).alias("again"))
    first = scratch.keep(seen.select("h", "m", "first.doc_id", "first.pos", "again"), "first")
    near = scratch.keep(near_lines(docs, scratch, first, min_words), "near")
    scratch.release()
    # the first of a near line, and all but the first of a repeated line
    gone = (first.select("h", "m", F.col("doc_id").alias("d"), F.col("pos").alias("p"), "again")
            .join(near.withColumn("near", F.lit(True)), ["h", "m"], "left").where("again OR near"))
    alone = gone.where("near AND NOT again").select(F.col("d").alias("doc_id"), F.col("p").alias("pos"))
    repeated = lines.join(gone.where("again"), ["h", "m"]).where("near OR doc_id <> d OR pos <> p").select("doc_id", "pos")
    out = scratch.keep(alone.union(repeated).groupBy("doc_id").agg(F.sort_array(F.collect_set("pos")).alias("dropped")), "dropped")
    for name in ("first", "near", "met", "lines", "live"):
        scratch.drop(name)
    return out


def dedup_lines(df: DataFrame, scratch: Scratch, min_words: int = 8, id_col: str = "doc_id", text_col: str = "text",
                keep: tuple[str, ...] = ("doc_id",), short: bool = False) -> DataFrame:
    """The ``keep`` columns of every row, with the text less its dropped lines, ``n_lines`` and ``dropped`` (numbers).

    A null text stays null with 0 lines, an empty text has one empty line.
    Rows that repeat an id and text are the same document: all keep the same
    lines.  Other columns may have any names; an empty table gives no rows."""
    gone = dropped_lines(df, scratch, min_words, id_col, text_col, short).toDF("_id", "_dropped")
    known = F.col(id_col).isNotNull() & F.col(text_col).isNotNull()
    rows = df.select(F.when(known, _document(id_col, text_col)).alias("_key"), F.col(text_col).alias("_text"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)])
    both = rows.join(gone.hint("merge"), F.col("_key") == F.col("_id"), "left")
    lines = F.split("_text", "\n")
    kept = F.when(F.col("_dropped").isNull(), F.col("_text")).otherwise(F.array_join(F.filter(
        lines, lambda x, i: ~F.array_contains(F.col("_dropped"), i)), "\n"))
    return both.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], kept.alias("clean_text"),
                       F.when(F.col("_text").isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
                       F.coalesce("_dropped", F.array().cast("array<int>")).alias("dropped"))
