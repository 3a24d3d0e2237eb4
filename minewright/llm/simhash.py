"""SimHash fingerprints and permuted block tables, in DataFrame functions only."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minewright.llm.batches import rereadable
from minewright.operators.pairs import spread_join
from minewright.operators.ranks import numbered
from minewright.session import cut

#: Words of a term, and the two 64-bit halves of a fingerprint.
TERM_WORDS, HALVES, BITS = 3, 2, 128
_SPACES = " \t\n\u000b\f\r"
_PAIR = 0x0000000100000001


def _terms(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, hash, weight`` of every run of three words (or the whole shorter text); one row without hash for a wordless text."""
    trimmed = F.btrim(F.lower(F.coalesce("text", F.lit(""))), F.lit(_SPACES))
    split = (texts.withColumn("words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+")))
             .withColumn("n_words", F.size("words")))
    shifted = [F.slice("words", k + 1, F.greatest(F.col("n_words"), F.lit(1))).alias(f"w{k}") for k in range(TERM_WORDS)]
    runs = split.select(*keys, "n_words", F.inline_outer(F.arrays_zip(*shifted)))
    last = F.when(F.col("n_words") >= TERM_WORDS, F.col(f"w{TERM_WORDS - 1}").isNotNull()).when(
        F.col("n_words") > 1, F.col("w1").isNotNull()).otherwise(F.lit(True))
    return runs.where(last).select(*keys, F.when(F.col("n_words") > 0, F.xxhash64("w0", "w1", "w2")).alias("hash"),
                                   F.octet_length("w0").cast("long").alias("weight"))


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, high, low``: the 128-bit SimHash of the whole ``text`` of each key.

    Terms are runs of three words, lower-cased; each occurrence votes with the bytes of its first word, so long words count
    more. A term's hash adds its weight to every bit that is set; a bit of the fingerprint is set if that makes
    more than half of all weight. Two counters of 32 bits share a sum, so 64 sums hold all votes and are combined before any
    shuffle. A text without words has fingerprint 0; equal texts have equal fingerprints.
    """
    votes = _terms(texts, keys).withColumn("other", F.when(F.col("hash").isNotNull(), F.xxhash64("hash", F.lit(TERM_WORDS))))
    sums = [F.sum(F.shiftrightunsigned(half, i).bitwiseAND(F.lit(_PAIR)) * F.col("weight")).alias(f"{half}{i}")
            for half in ("hash", "other") for i in range(32)]
    counted = votes.groupBy(*keys).agg(F.sum("weight").alias("total"), *sums)

    def half(name: str) -> Column:
        out = F.lit(0).cast("long")
        for i in range(32):
            for at, votes_for in ((i, F.col(f"{name}{i}").bitwiseAND(F.lit(0xFFFFFFFF))), (i + 32, F.shiftrightunsigned(f"{name}{i}", 32))):
                out = out.bitwiseOR(F.when(2 * votes_for > F.col("total"), F.lit(1 << at if at < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")))
        return F.coalesce(out, F.lit(0).cast("long"))

    return counted.select(*keys, half("hash").alias("high"), half("other").alias("low"))


def distance(a_high: Column, a_low: Column, b_high: Column, b_low: Column) -> Column:
    """Bits that differ."""
    return F.bit_count(a_high.bitwiseXOR(b_high)) + F.bit_count(a_low.bitwiseXOR(b_low))


def likeness(a_high: Column, a_low: Column, b_high: Column, b_low: Column) -> Column:
    return 1 - distance(a_high, a_low, b_high, b_low) / F.lit(float(BITS))


def text_form(high: Column, low: Column) -> Column:
    """32 lower-case hexadecimal digits."""
    return F.lower(F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0")))


def edited_and_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row the id, ``n_chars``, ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``.

    The edited text has its last floor(n_chars / 2) characters replaced by the first as many (or all) of the next
    document's; the next one has the next smaller id, after the last comes the first. Likeness is the share of equal
    bits. The order is numbered on ids alone; of the next text only the needed beginning moves.

    A null text counts as empty. Null ids come last and equal ids follow in the order of the table; repeated rows are rows
    each. Other columns are not read; an empty table gives an empty result; a single row is its own next one.
    """
    texts = rereadable(docs).select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("id"),
                        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    places = numbered(texts.select("row", "id", F.length("text").alias("n_chars")).withColumn("all", F.lit(0))
                      .withColumn("unknown", F.col("id").isNull().cast("int")).withColumn("down", -F.col("id")), ["all"], ["unknown", "down", "row"], "place")
    places = places.select("row", "id", "place", (F.col("n_chars") / 2).cast("long").alias("need"))
    follow = (places.select(F.col("row").alias("of"), "id", "need", F.col("place").alias("at")).join(
        places.select(F.col("row").alias("next_row"), (F.col("place") - 1).alias("at")), "at", "left"))
    row_of_first = places.where("place = 0").select("row").first()
    follow = follow.withColumn("next_row", F.coalesce("next_row", F.lit(row_of_first[0] if row_of_first else None).cast("long")))
    # Both joins shuffle the same two columns by row, so the texts move once.
    whole = texts.select("row", "text")
    beginnings = (whole.join(follow, F.col("row") == F.col("next_row"))
                  .select("of", "id", "need", "next_row", F.expr("left(text, cast(need as int))").alias("beginning")))
    edited = F.concat(F.expr("left(text, cast(length(text) - need as int))"), "beginning")
    both = (whole.join(beginnings, F.col("row") == F.col("of")).withColumn("n_chars", F.length("text").cast("long"))
            .withColumn("edited", edited).withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)))
    keys = ["row", "id", "n_chars", "edited_sha256", "next_row"]
    forms = both.select(*keys, F.inline(F.array(F.struct(F.lit(0).alias("form"), F.col("text").alias("text")),
                                                F.struct(F.lit(1).alias("form"), F.col("edited").alias("text")))))
    prints = fingerprints(forms, [*keys, "form"])

    def of(form: int, name: str) -> Column:
        return F.max(F.when(F.col("form") == form, F.col(name))).alias(f"{name}{form}")

    rows = cut(prints.groupBy(*keys).agg(of(0, "high"), of(0, "low"), of(1, "high"), of(1, "low")), "prints")
    after = rows.select(F.col("row").alias("next_row"), F.col("high0").alias("high_next"), F.col("low0").alias("low_next"))
    here, edit, there = ((F.col(f"high{x}"), F.col(f"low{x}")) for x in ("0", "1", "_next"))
    return rows.join(after, "next_row").select(
        F.col("id").alias(id_column), "n_chars", "edited_sha256", text_form(*here).alias("fingerprint"), text_form(*edit).alias("edited_fingerprint"),
        likeness(*here, *edit).alias("near_edited"), likeness(*here, *there).alias("near_next"))


def within(queries: DataFrame, prints: DataFrame, radius: int = 3, spare: int = 2) -> DataFrame:
    """``query_id, id, distance`` of all ``prints(id, high, low)`` at most ``radius`` bits from each of ``queries(id, high, low)``.

    A fingerprint is cut into ``radius + spare`` blocks. Of any two within the radius at least ``spare`` blocks agree, so there
    is a table for every choice of ``spare`` blocks, keyed by them, and every match is in one of them. Equal fingerprints meet
    once; a crowded key is cut into parts that the queries visit one by one. Null fingerprints match nothing.
    """
    blocks = radius + spare
    edges = [BITS * k // blocks for k in range(blocks + 1)]

    def block(k: int) -> Column:
        """Bits edges[k] to edges[k + 1], counted from the lowest of ``low``."""
        a, b = edges[k], edges[k + 1]
        parts = []
        for name, base in (("low", 0), ("high", 64)):
            x, y = max(a, base), min(b, base + 64)
            if x < y:
                mask = (1 << (y - x)) - 1 if y - x < 64 else -1
                parts.append(F.shiftrightunsigned(name, x - base).bitwiseAND(F.lit(mask).cast("long")))
        return F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)]).cast("string")

    def tables(df: DataFrame) -> DataFrame:
        distinct = df.select("high", "low").where("high is not null and low is not null").distinct()
        keys = F.array(*[F.xxhash64(F.lit(t), *[block(k) for k in chosen]) for t, chosen in enumerate(combinations(range(blocks), spare))])
        return distinct.select("high", "low", F.explode(F.array_distinct(keys)).alias("key"))

    asked = tables(queries).select("key", F.col("high").alias("q_high"), F.col("low").alias("q_low"))
    met = spread_join(asked, tables(prints), ["key"])
    far = distance(F.col("q_high"), F.col("q_low"), F.col("high"), F.col("low"))
    close = met.withColumn("distance", far).where(F.col("distance") <= radius).select("q_high", "q_low", "high", "low", "distance").distinct()
    named = close.join(queries.select(F.col("id").alias("query_id"), F.col("high").alias("q_high"), F.col("low").alias("q_low")), ["q_high", "q_low"])
    return named.join(prints.select("id", "high", "low"), ["high", "low"]).select("query_id", "id", "distance")
