"""Personal data by weak supervision, in DataFrame functions only.

Regular expressions propose spans. Labelers (shape, gazetteer, context, check, edges) vote +1, 0 or -1 on each. Votes are
counted by pattern, expectation-maximisation estimates how reliable each labeler is and how likely each pattern is
personal data, and a logistic span classifier is trained on these probabilities. Only the table of vote patterns, at most
3**5 a kind, reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakekit.llm.common import stored

# Kinds in the order in which spans are listed; the first four have base rules.
KINDS = ("email", "ip", "card", "phone", "secret", "person")
BASE = 4

# The base patterns. Possessive repeats and looked-behind starts give the same matches as the plain forms, without their
# quadratic search on long runs: a match that fails at the start of a run of its first characters fails inside it too.
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Proposals beyond the base, only taken if the classifier says so.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%-])[A-Za-z0-9._%-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])",
    "secret": r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,}+|[A-Za-z]{2,4}_[A-Za-z0-9]{20,}+)(?![A-Za-z0-9])",
    "person": r"(?<!\p{L})(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Monsieur|Madame|Señor|Señora)\.? \p{Lu}\p{Ll}++(?: \p{Lu}\p{Ll}++)?",
}
# A text without any of these characters can't match.
ANCHORS = {
    ("email", True): "@",
    ("ip", True): r"[0-9]\.[0-9]",
    ("card", True): r"[0-9][\x20-]?[0-9]",
    ("phone", True): r"\+[0-9]",
    ("email", False): r"[\[(]at[\])]",
    ("phone", False): r"[0-9]{3}[ .-][0-9]{4}",
    ("secret", False): r"[0-9a-f]{32}|[A-Za-z]_[A-Za-z0-9]{20}",
    ("person", False): r"Mr|Ms|Dr|Prof|Herr|Frau|Mme|Mon|Mad|Se",
}

# Gazetteers and words of context.
DOMAINS = ("com", "org", "net", "edu", "gov", "de", "fr", "es", "uk", "eu", "io", "info", "it", "nl", "ch", "at", "co", "us")
NAMES = (
    "James", "Mary", "John", "Anna", "Peter", "Maria", "Thomas", "Laura", "Michael", "Sarah", "David", "Julia", "Hans",
    "Klaus", "Sabine", "Jean", "Marie", "Pierre", "Claire", "José", "Carmen", "Juan", "Lucía", "Carlos", "Smith", "Müller",
    "Schmidt", "Martin", "Dubois", "García", "López",
)
CONTEXT = {
    "email": r"mail|contact|write|kontakt|contacter|correo|@",
    "ip": r"\bip\b|host|server|address|adresse|client|login|dirección",
    "card": r"card|visa|master|credit|karte|carte|tarjeta|pay",
    "phone": r"tel|phone|call|fax|mobil|anruf|appel|llam",
    "secret": r"token|key|secret|password|passwd|bearer|auth",
    "person": r"dear|name|sehr|cher|estimad|signed|author",
}
AGAINST = r"version|isbn|issn|\bdoi\b|order|invoice|\bv\.? ?$|#$|section|chapter|sha|md5|commit|checksum"
LABELERS = ("shape", "gazetteer", "context", "check", "edges")
# Votes of each value that every labeler is taken to have cast beforehand in either class: keeps rates off 0 and 1.
PSEUDO_VOTES = 1.0
EM_ROUNDS = 200
THRESHOLD = 0.5


# The patterns of all proposals: (kind, whether by the base rule, pattern).
PROPOSED = (*((k, True, p) for k, p in PATTERNS.items()), *((k, False, p) for k, p in LOOSE.items()))


def _spans(kind: str, base: bool, matches: str, gaps: str, following: str) -> Column:
    """Matches in order: kind, base, place in order, length of the gap before, its last characters, match, what follows."""

    def span(z: Column, i: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("kind"),
            F.lit(base).alias("base"),
            i.alias("i"),
            F.length(z[gaps]).alias("gap"),
            F.right(z[gaps], F.lit(30)).alias("before"),
            z[matches].alias("match"),
            F.left(z[following], F.lit(2)).alias("after"),
        )

    return F.filter(F.transform(F.arrays_zip(matches, gaps, following), span), lambda s: s["match"].isNotNull())


def proposals(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per proposed span of a document, or one with NULLs: row, doc_id, text_hash, kind, base, start, end, ...

    One pass over whole texts; only spans and 30 characters before them go on. Places count code points. A text is cut
    at the matches, and running lengths of the pieces give the places.
    """
    text, none = F.coalesce(docs[text_col], F.lit("")), F.array().cast("array<string>")
    cut = {}
    for i, (kind, base, pattern) in enumerate(PROPOSED):
        possible = F.regexp_like(text, F.lit(ANCHORS[kind, base]))
        cut[f"m{i}"] = F.when(possible, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
        cut[f"g{i}"] = F.when(possible, F.split(text, pattern, -1)).otherwise(none)
    pieces = docs.select(
        F.monotonically_increasing_id().alias("row"),
        docs[id_col].alias("doc_id"),
        F.xxhash64(docs[text_col]).alias("text_hash"),
        *[c.alias(n) for n, c in cut.items()],
    )
    shifted = {f"f{i}": F.when(F.size(f"g{i}") > 0, F.slice(f"g{i}", 2, F.size(f"g{i}"))).otherwise(none) for i in range(len(PROPOSED))}
    every = F.concat(*[_spans(k, b, f"m{i}", f"g{i}", f"f{i}") for i, (k, b, _) in enumerate(PROPOSED)])
    rows = pieces.withColumns(shifted).select("row", "doc_id", "text_hash", F.explode_outer(every).alias("s"))
    kept = stored(rows.select("row", "doc_id", "text_hash", "s.*"), "pii-proposals")
    length = F.length("match")
    order = Window.partitionBy("row", "kind", "base").orderBy("i")
    return kept.withColumn("end", F.sum(F.col("gap") + length).over(order)).withColumn("start", F.col("end") - length)


def luhn(digits: Column) -> Column:
    """True if a text of digits passes the Luhn check."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda c: c.cast("int"))

    def worth(d: Column, i: Column) -> Column:
        double = d * 2
        return F.when(i % 2 == 0, d).otherwise(double - F.when(double > 9, 9).otherwise(0))

    return F.aggregate(F.transform(values, worth), F.lit(0), lambda s, x: s + x) % 10 == 0


def with_checks(spans: DataFrame) -> DataFrame:
    """Adds `valid`: whether a match passes the base checks of its kind; NULL for kinds without any."""
    digits = F.regexp_replace("match", r"[^0-9]", "")
    n = F.length(digits)
    part = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    valid = (
        F.when(F.col("kind") == "email", F.lit(True))
        .when(F.col("kind") == "ip", F.regexp_like("match", F.lit(rf"^{part}(?:\.{part}){{3}}$")))
        .when(F.col("kind") == "card", F.when(n.between(16, 19), luhn(digits)).otherwise(False))
        .when(F.col("kind") == "phone", n.between(8, 15))
    )
    return spans.withColumn("valid", valid)


def with_votes(spans: DataFrame) -> DataFrame:
    """Adds the five votes and their pattern."""
    kind, before = F.col("kind"), F.lower("before")
    yes, no, none = F.lit(1), F.lit(-1), F.lit(0)
    digits = F.regexp_replace("match", r"[^0-9]", "")
    shape = F.when(F.col("base"), yes).otherwise(none)
    gazetteer = (
        F.when(kind == "email", F.when(F.lower(F.regexp_extract("match", r"([A-Za-z0-9-]+)$", 1)).isin(*DOMAINS), yes).otherwise(none))
        .when(kind == "ip", F.when(F.regexp_like("match", F.lit(r"^(?:0+|127|22[4-9]|2[3-5][0-9])\.")), no).otherwise(yes))
        .when(kind == "card", F.when(F.regexp_like(digits, F.lit("^[3-6]")), yes).otherwise(no))
        .when(kind == "phone", F.when(F.regexp_like(digits, F.lit(r"^([0-9])\1+$")), no).otherwise(yes))
        .when(kind == "person", F.when(F.regexp_like("match", F.lit("|".join(NAMES))), yes).otherwise(none))
        .otherwise(none)
    )
    context = F.when(F.regexp_like(before, F.lit(AGAINST)), no)
    for k, words in CONTEXT.items():
        context = context.when((kind == k) & F.regexp_like(before, F.lit(words)), yes)
    check = (
        F.when(kind == "secret", F.when(F.regexp_like("match", F.lit("[0-9]")) & F.regexp_like("match", F.lit("[A-Za-z]")), yes).otherwise(no))
        .when(F.col("valid").isNull() | ~F.col("base"), none)
        .otherwise(F.when(F.col("valid"), yes).otherwise(no))
    )
    inside = F.regexp_like("before", F.lit(r"[\p{L}0-9_]$")) | F.regexp_like("after", F.lit(r"^(?:[\p{L}0-9_]|[.-][0-9])"))
    votes = (shape, gazetteer, context.otherwise(none), check, F.when(inside, no).otherwise(yes))
    named = spans.withColumns(dict(zip(LABELERS, votes)))
    return named.withColumn("pattern", F.concat_ws(",", *LABELERS))


@dataclass(frozen=True)
class SpanModel:
    """Reliabilities found by EM, and the classifier: a weight per kind, labeler and vote."""

    priors: dict[str, float]
    rates: dict[str, np.ndarray]  # labeler to [class, vote + 1]
    weights: dict[str, float]

    def score(self, kind: str, votes: Sequence[int]) -> float:
        z = self.weights.get(kind, 0.0) + sum(self.weights.get(f"{n}{v}", 0.0) for n, v in zip(LABELERS, votes))
        return 1 / (1 + np.exp(-z))


def estimate(counts: dict[tuple[str, tuple[int, ...]], int]) -> tuple[dict[str, float], dict[str, np.ndarray], dict]:
    """EM over counted vote patterns: priors by kind, rates of votes by class, and each pattern's probability.

    Nothing is known of any labeler beforehand. Which class is the personal one follows from the beliefs at the start alone,
    the balance of a pattern's votes.
    """
    keys = sorted(counts)
    n = np.array([counts[k] for k in keys], float)
    votes = np.array([k[1] for k in keys])
    kinds = np.array([k[0] for k in keys])
    belief = np.clip(0.5 + 0.15 * votes.sum(axis=1), 0.05, 0.95)
    priors, rates = {}, {}
    for _ in range(EM_ROUNDS):
        for k in set(kinds.tolist()):
            of = kinds == k
            priors[k] = float((n[of] @ belief[of] + 1) / (n[of].sum() + 2))
        for j, name in enumerate(LABELERS):
            table = np.full((2, 3), PSEUDO_VOTES)
            np.add.at(table[0], votes[:, j] + 1, n * (1 - belief))
            np.add.at(table[1], votes[:, j] + 1, n * belief)
            rates[name] = table / table.sum(axis=1, keepdims=True)
        z = np.array([np.log(priors[k] / (1 - priors[k])) for k in kinds.tolist()])
        for j, name in enumerate(LABELERS):
            z += np.log(rates[name][1, votes[:, j] + 1] / rates[name][0, votes[:, j] + 1])
        belief = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return priors, rates, dict(zip(keys, belief))


def train(counts: dict[tuple[str, tuple[int, ...]], int]) -> SpanModel:
    """The span classifier: ridge-regularised logistic regression on EM's probabilities, by Newton steps."""
    if not counts:
        return SpanModel({}, {}, {})
    priors, rates, belief = estimate(counts)
    names = [*KINDS, *(f"{name}{v}" for name in LABELERS for v in (-1, 0, 1))]
    x = np.zeros((len(belief), len(names)))
    for i, (kind, votes) in enumerate(belief):
        for name in (kind, *(f"{n}{v}" for n, v in zip(LABELERS, votes))):
            x[i, names.index(name)] = 1
    y = np.array(list(belief.values()))
    n = np.array([counts[k] for k in belief], float)
    w = np.zeros(len(names))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (p - y)) + 0.05 * w
        hessian = (x.T * (n * p * (1 - p))) @ x + 0.05 * np.eye(len(w))
        w = w - np.linalg.solve(hessian + 1e-6 * np.eye(len(w)), gradient)
    return SpanModel(priors, rates, dict(zip(names, map(float, w))))


def _margin(model: SpanModel) -> Column:
    """The classifier as an expression over kind and votes."""
    def weight(name: Column) -> Column:
        table = F.create_map(*[F.lit(x) for pair in model.weights.items() for x in pair])
        return F.coalesce(F.try_element_at(table, name), F.lit(0.0))

    if not model.weights:
        return F.lit(-1.0)
    total = weight(F.col("kind"))
    for name in LABELERS:
        total = total + weight(F.concat(F.lit(name), F.col(name).cast("string")))
    return total


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(row, doc_id, text_hash, kind, start, end, base): the spans of personal data; a row with NULL kind if none.

    Base spans are matches of the base patterns that pass their kind's checks. Other proposals become spans if the
    classifier's probability reaches the threshold and they don't overlap a base span; of two that overlap, the earlier
    stays. `row` numbers the rows of the documents. NULL and empty texts have no spans, an empty table no rows. Rows of
    the same id are searched one by one; other columns don't matter.
    """
    spans = stored(with_votes(with_checks(proposals(docs, id_col, text_col))), "pii-votes")
    # A text counts once, however many copies it has. At most 3**5 rows a kind come back.
    once = spans.where("kind IS NOT NULL").select("text_hash", "kind", "base", "i", "pattern").distinct()
    tally = once.groupBy("kind", "pattern").count().collect()
    model = train({(r["kind"], tuple(map(int, r["pattern"].split(",")))): r["count"] for r in tally})
    sure = F.col("base") & F.coalesce("valid", F.lit(False))
    logit = float(np.log(threshold / (1 - threshold)))
    judged = spans.withColumn("sure", sure).withColumn("taken", F.col("sure") | (_margin(model) >= logit))
    taken = judged.withColumns({c: F.when(F.col("taken"), F.col(c)) for c in ("kind", "start", "end", "sure")})
    order = Window.partitionBy("row").orderBy("start", "end", "kind")
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    clear = (
        F.coalesce(F.max(F.when(F.col("sure"), F.col("end"))).over(before) <= F.col("start"), F.lit(True))
        & F.coalesce(F.min(F.when(F.col("sure"), F.col("start"))).over(after) >= F.col("end"), F.lit(True))
        & F.coalesce(F.max("end").over(before) <= F.col("start"), F.lit(True))
    )
    placed = taken.withColumn("kept", F.col("sure") | clear)
    return placed.select("row", "doc_id", "text_hash", *[F.when(F.col("kept"), F.col(c)).alias(c) for c in ("kind", "start", "end")],
                         (F.col("kept") & F.col("sure")).alias("base"))


def _listed(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the order of KINDS, then start."""
    return F.array_join(F.transform(F.sort_array(spans), lambda s: s["shown"]), ",")


def summarise(spans: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) per row of the documents."""
    rank = F.coalesce(*[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate(KINDS)])
    shown = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string"))
    item = F.struct(rank.alias("rank"), "start", "end", shown.alias("shown"))
    found = F.col("kind").isNotNull()
    grouped = spans.groupBy("row").agg(
        F.any_value("doc_id").alias("doc_id"),
        *[F.count_if((F.col("kind") == k) & F.col("base")).alias(f"n_{k}") for k in KINDS[:BASE]],
        F.collect_list(F.when(found & F.col("base"), item)).alias("base_spans"),
        F.collect_list(F.when(found, item)).alias("all_spans"),
    )
    return grouped.select(
        "doc_id",
        *[f"n_{k}" for k in KINDS[:BASE]],
        F.sha2(_listed(F.col("base_spans")), 256).alias("base_sha256"),
        _listed(F.col("all_spans")).alias("spans"),
    )


def mask(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents with every span replaced by its kind in brackets; all rows and columns stay.

    Spans that overlap are replaced together by the first one's kind. Texts without spans, NULL too, stay as they are.
    Spans are joined to the texts by id and text, so rows alike are masked alike.
    """
    found = find_spans(docs, id_col, text_col, threshold).where("kind IS NOT NULL")
    item = F.struct("start", "end", "kind")
    by_text = found.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set(item)).alias("spans"))
    keyed = by_text.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("spans").alias("_spans"))
    packed = docs.select(F.struct(*docs.columns).alias("_row"), docs[id_col].alias("_key"), docs[text_col].alias("_text"))
    joined = packed.join(keyed, (F.xxhash64("_text") == F.col("_hash")) & F.col("_key").eqNullSafe(F.col("_id")), "left")

    def step(state: Column, s: Column) -> Column:
        at = state["at"]
        piece = F.concat(F.substring(F.col("_text"), at + 1, s["start"] - at), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(
            F.when(s["start"] >= at, F.concat(state["out"], piece)).otherwise(state["out"]).alias("out"),
            F.greatest(at, s["end"]).cast("int").alias("at"),
        )

    spans = F.transform("_spans", lambda s: F.struct(s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end"), s["kind"].alias("kind")))
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    masked = F.aggregate(
        spans, start, step, lambda s: F.concat(s["out"], F.substring(F.col("_text"), s["at"] + 1, F.length("_text")))
    )
    text = F.when(F.col("_spans").isNotNull(), masked).otherwise(F.col("_text"))
    return joined.select(*[text.alias(c) if c == text_col else F.col("_row")[c].alias(c) for c in docs.columns])
