"""Personal data by weak supervision: labelers vote on spans, EM weighs them, a classifier decides. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from minewright.llm.batches import rereadable
from minewright.session import cut

# The base kinds in their order. A run is entered at its first character only (or where the
# last match ended), and runs are not given back, so that long runs without a match cost one pass.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Further spans that may be personal data: their kind, what they look like, and what a text with one must contain.
WIDER = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?(?:\[at\]|\(at\)) ?[A-Za-z0-9-]{1,63}(?: ?(?:\[dot\]|\(dot\)|\.) ?[A-Za-z0-9-]{1,63}){1,4}", r"[\[(]at[\])]"),
    "phone": (r"(?<![0-9A-Za-z.+-])(?<![0-9] )(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z-]| [0-9]{4})", r"[0-9][ .)-]"),
    "id": (r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", r"[0-9]-[0-9]"),
    "iban": (r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])", r"[A-Z]{2}[0-9]{2}"),
}
KINDS = [*BASE, *(k for k in WIDER if k not in BASE)]
#: Words before a span that speak for its kind, and words or signs that speak for a plain number.
CUES = {
    "email": "mail|contact|write|kontakt|correo|courriel|schreib",
    "ip": "ip|host|server|address|adresse|client|login",
    "card": "card|visa|mastercard|amex|credit|karte|carte|tarjeta|konto",
    "phone": "phone|tel|call|mobile|fax|dial|whatsapp|anruf|llam|appel",
    "id": "ssn|social|security|passport|ausweis|id",
    "iban": "iban|account|bank|konto|compte|cuenta",
}
DOUBTS = r"(version|vers\.|\bv|isbn|order|invoice|article|figure|table|section|page|chapter|\$|€|£|#|=)\s*$"
#: Gazetteers: mail domains' endings, country calling codes of two large regions, bank countries.
DOMAINS = ["com", "org", "net", "edu", "gov", "io", "info", "de", "fr", "es", "uk", "eu", "it", "nl", "ch", "at", "be", "us", "ca", "example"]
COUNTRIES = ["AT", "BE", "CH", "CZ", "DE", "DK", "ES", "FI", "FR", "GB", "IE", "IT", "LU", "NL", "NO", "PL", "PT", "SE"]
VOTERS = ["shape", "gazetteer", "cue", "doubt", "edges"]
#: Marks a match in a text; a text's own mark is first replaced by another sign of no pattern.
MARK, INSTEAD = "\u0001", "\u0002"


def _matches(texts: DataFrame, tables: list[tuple[str, str, str, str]]) -> DataFrame:
    """``row, kind, layer, start, end, span, before, after`` of all matches of ``(kind, layer, pattern, needs)``, left to right.

    A pattern marks its matches, the marks split the text, and running lengths of the pieces give the places; texts are
    not shuffled, only matches and lengths are.
    """
    text = F.translate("text", MARK, INSTEAD)
    marked = F.array_compact(F.array(*[F.when(F.col("text").rlike(needs) & F.col("text").rlike(pattern), F.struct(
        F.lit(kind).alias("kind"), F.lit(layer).alias("layer"),
        F.split(F.regexp_replace(text, f"({pattern})", f"{MARK}$1{MARK}"), MARK).alias("pieces"))) for kind, layer, pattern, needs in tables]))
    pieces = (texts.where(F.col("text").rlike("[0-9]|@|[\\[(]at[\\])]")).select("row", F.inline(marked))
              .select("row", "kind", "layer", F.posexplode("pieces").alias("place", "piece"))
              .select("row", "kind", "layer", "place", F.length("piece").cast("long").alias("size"), F.when(F.col("place") % 2 == 1, F.col("piece")).alias("span"),
                      F.when(F.col("place") % 2 == 0, F.right("piece", F.lit(24))).alias("tail"), F.when(F.col("place") % 2 == 0, F.left("piece", F.lit(1))).alias("head")))
    order = Window.partitionBy("row", "kind", "layer").orderBy("place")
    ends = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = pieces.select("row", "kind", "layer", "span", (ends - F.col("size")).alias("start"), ends.alias("end"),
                           F.lag("tail").over(order).alias("before"), F.lead("head").over(order).alias("after"))
    return placed.where("span is not null")


def _digits(span: str) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def base_valid(kind: str, span: str) -> Column:
    """Whether a match of a base pattern counts."""
    digits = _digits(span)
    byte = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
    return (F.when(F.col(kind) == "email", F.lit(True))
            .when(F.col(kind) == "ip", F.col(span).rlike(rf"^{byte}\.{byte}\.{byte}\.{byte}$"))
            .when(F.col(kind) == "card", F.length(digits).between(13, 19) & F.call_function("luhn_check", F.when(F.length(digits).between(13, 19), digits).otherwise("1")))
            .otherwise(F.length(digits).between(9, 15)))


def _voted(spans: DataFrame) -> DataFrame:
    """Votes of the labelers, -1, 0 or 1, and the features of the classifier."""
    digits, before = _digits("span"), F.lower(F.coalesce("before", F.lit("")))
    of = {kind: F.col("kind") == kind for kind in KINDS}

    def chosen(by_kind: dict[str, Column], otherwise: Column) -> Column:
        out = otherwise
        for kind, value in by_kind.items():
            out = F.when(of[kind], value).otherwise(out)
        return out

    yes, no = F.lit(1), F.lit(-1)
    monotone = digits.rlike(r"^([0-9])\1*$") | F.lit("01234567890123456789").contains(digits) | F.lit("98765432109876543210").contains(digits)
    shape = F.when(F.col("layer") == "base", F.when(base_valid("kind", "span"), yes).otherwise(no)).otherwise(chosen({
        "phone": F.when(F.length(digits).between(9, 11), yes).otherwise(no),
        "id": F.when(F.col("span").rlike("^(000|666|9)|-00-|-0000$"), no).otherwise(yes)}, F.lit(0)))
    cue = chosen({kind: before.rlike(rf"\b(?:{words})[\w.]*\W{{0,12}}$") for kind, words in CUES.items()}, F.lit(False))
    gazetteer = chosen({
        "email": F.when(F.lower(F.regexp_extract("span", "([A-Za-z0-9-]+)$", 1)).isin(DOMAINS), yes).otherwise(0),
        "phone": F.when(F.col("span").rlike(r"^\+(?:1|3[0-9]|4[0-9])\D"), yes).otherwise(0),
        "iban": F.when(F.substring("span", 1, 2).isin(COUNTRIES), yes).otherwise(no)}, F.lit(0))
    glued = before.rlike(r"[\w]$") | F.coalesce("after", F.lit("")).rlike(r"^[\w]")
    return (spans.withColumn("valid", (F.col("layer") == "base") & base_valid("kind", "span"))
            .withColumn("shape", F.when(monotone & (F.length(digits) > 3) & ~of["email"], no).otherwise(shape))
            .withColumn("gazetteer", gazetteer).withColumn("cue", F.when(cue, 1).otherwise(0))
            .withColumn("doubt", F.when(before.rlike(DOUBTS), no).otherwise(0)).withColumn("edges", F.when(glued, no).otherwise(yes))
            .withColumn("long", F.least(F.floor(F.length("span") / 6), F.lit(5)).cast("int"))
            .withColumn("digit_share", F.floor(4 * F.length(digits) / F.length("span")).cast("int")))


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """EM over vote patterns with counts: the share of true spans, and P(vote | true), P(vote | false) of each labeler.

    Starts from the majority; a smoothing of one pattern per outcome keeps every probability above 0.
    """
    belief = [1 / (1 + math.exp(-sum(votes))) for votes, _ in patterns]
    share, tables = 0.5, []
    for _ in range(rounds):
        true = sum(b * n for b, (_, n) in zip(belief, patterns))
        false = sum((1 - b) * n for b, (_, n) in zip(belief, patterns))
        share, tables = (true + 1) / (true + false + 2), []
        for k in range(len(VOTERS)):
            tables.append({vote: ((sum(b * n for b, (v, n) in zip(belief, patterns) if v[k] == vote) + 1) / (true + 3),
                                  (sum((1 - b) * n for b, (v, n) in zip(belief, patterns) if v[k] == vote) + 1) / (false + 3)) for vote in (-1, 0, 1)})
        belief = [posterior(share, tables, votes) for votes, _ in patterns]
    return share, tables


def posterior(share: float, tables: list, votes: tuple[int, ...]) -> float:
    odds = math.log(share / (1 - share)) + sum(math.log(table[v][0] / table[v][1]) for table, v in zip(tables, votes))
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


FEATURES = [*VOTERS, "long", "digit_share"]


def _train(rows: list[Row]) -> dict[str, tuple[float, dict[tuple[str, int], float]]]:
    """Per kind the bias and the weights of (feature, value): logistic regression on the beliefs, each weighed by its spans.

    ``rows`` are the distinct (kind, features) with counts, at most some thousands whatever the corpus.
    """
    models = {}
    for kind in {r["kind"] for r in rows}:
        own = [r for r in rows if r["kind"] == kind]
        counts: dict = {}
        for r in own:
            votes = tuple(r[v] for v in VOTERS)
            counts[votes] = counts.get(votes, 0) + r["n"]
        share, tables = reliabilities(sorted(counts.items()))
        examples = [([(f, r[f]) for f in FEATURES], posterior(share, tables, tuple(r[v] for v in VOTERS)), r["n"]) for r in own]
        total = sum(n for _, _, n in examples)
        bias, weights = 0.0, {x: 0.0 for xs, _, _ in examples for x in xs}
        for _ in range(300):
            slope, slopes = 0.0, dict.fromkeys(weights, 0.0)
            for xs, wanted, n in examples:
                wrong = n / total * (1 / (1 + math.exp(-max(-30.0, min(30.0, bias + sum(weights[x] for x in xs))))) - wanted)
                slope += wrong
                for x in xs:
                    slopes[x] += wrong
            bias -= slope
            for x in weights:
                weights[x] -= slopes[x] + 1e-4 * weights[x]
        models[kind] = bias, weights
    return models


def personal_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rows (``row``, id), and ``row, kind, layer, start, end, span, valid, belief`` of all spans kept.

    Base spans are the valid matches of ``BASE``; they always stay. Other spans (wider patterns, and base matches that
    were not valid are no candidates) stay if the classifier gives one half or more and they overlap no base span.
    Labelers vote on every candidate of the corpus; the counts of the distinct vote and feature rows, a table of
    bounded size, train EM and classifier on the driver.
    """
    texts = rereadable(docs).select(F.monotonically_increasing_id().alias("row"), F.col(id_column).cast("long").alias("id"),
                        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    tables = [(kind, "base", pattern, "@" if kind == "email" else "[0-9]") for kind, pattern in BASE.items()]
    tables += [(kind, "wider", pattern, needs) for kind, (pattern, needs) in WIDER.items()]
    voted = cut(_voted(_matches(texts.select("row", "text"), tables)).where("valid or layer = 'wider'"), "spans")
    models = _train(voted.groupBy("kind", *FEATURES).agg(F.count("*").alias("n")).collect())
    score = F.lit(0.0)
    for kind, (bias, weights) in sorted(models.items()):
        own = F.lit(bias)
        for feature in FEATURES:
            values = {v: w for (f, v), w in weights.items() if f == feature}
            term = F.lit(0.0)
            for value, weight in sorted(values.items()):
                term = F.when(F.col(feature) == value, F.lit(weight)).otherwise(term)
            own = own + term
        score = F.when(F.col("kind") == kind, own).otherwise(score)
    scored = voted.withColumn("belief", 1 / (1 + F.exp(-score)))
    order = Window.partitionBy("row").orderBy("start", "end", "kind", "layer")
    base_end = F.max(F.when(F.col("valid"), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    base_start = F.min(F.when(F.col("valid"), F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    kept = scored.withColumn("clear", (F.coalesce(base_end, F.lit(-1)) <= F.col("start")) & (F.coalesce(base_start, F.col("end")) >= F.col("end")))
    return texts.select("row", "id"), kept.where("valid or (belief >= 0.5 and clear)")


def personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row the id, ``n_email, n_ip, n_card, n_phone`` and ``base_sha256`` of the base spans, ``spans`` (all of them), ``n_added``.

    A null text counts as empty and has no spans; texts may hold any characters (control signs do not disturb the marks).
    Null ids and repeated rows are searched each; other columns are not read; an empty table gives an empty result.
    """
    rows, spans = personal_spans(docs, id_column, text_column)
    number = F.create_map(*[x for k, kind in enumerate(KINDS) for x in (F.lit(kind), F.lit(k))])
    entry = F.struct(number[F.col("kind")].alias("k"), "start", "end", F.concat_ws(":", "kind", "start", "end").alias("name"))
    names = lambda entries: F.array_join(F.transform(F.array_sort(entries), lambda e: e["name"]), ",")
    found = spans.groupBy("row").agg(
        *[F.count(F.when(F.col("valid") & (F.col("kind") == kind), 1)).alias(f"n_{kind}") for kind in BASE],
        F.count(F.when(~F.col("valid"), 1)).alias("n_added"),
        names(F.collect_list(F.when(F.col("valid"), entry))).alias("base"), names(F.collect_list(entry)).alias("spans"))
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in (*[f"n_{kind}" for kind in BASE], "n_added")]
    return rows.join(found, "row", "left").select(
        F.col("id").alias(id_column), *zero[:4], F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"), zero[4])

