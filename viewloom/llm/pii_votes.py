"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs them.

Base spans come from fixed patterns and checks, and stay whatever the votes say. Further candidates come from looser
patterns (numbers that fail a check, written-out addresses, phone numbers without a plus). Four labelers vote on every
candidate, base ones included: its form (regular expressions and check digits), a gazetteer (endings of domains, number
ranges of card issuers, country codes, reserved networks), the words around it, and its neighbouring characters.

How often each pattern of votes occurs is counted over all documents. EM on that table, of at most 3^4 rows a kind,
estimates each labeler's reliability without any label; its posteriors train a logistic classifier of the votes, which
decides on the candidates that are not base. The texts are handled by Spark expressions alone.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewloom.llm.common import query, scratch, stored, table

KINDS = ("email", "ip", "card", "phone")

#: Patterns of base spans, in forms that find the same matches in time linear in the text: runs are possessive, and a
#: match can start only where a run of its first characters does (or where the last match ended).
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Further candidates by kind.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:[(\[]dot[)\]]|\.)\x20?[A-Za-z0-9-]{1,63}+){1,4}+",
    "phone": r"(?<![0-9A-Za-z+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9A-Za-z-])",
}
#: A text without these, or without a digit where none is named, has no match, which is quicker to see.
NEEDS = {"email": "@", "ip": ".", "phone": "+"}
NEEDS_LOOSE = {"email": "at"}

# What the gazetteer knows.
DOMAIN_ENDS = "com org net edu gov mil int info biz io dev app eu us uk de fr es it nl be ch at se no dk fi pl pt ie ca au nz jp cn in br mx ru za kr".split()
CARD_PREFIXES = r"^(?:4|5[1-5]|2[2-7]|3[47]|30[0-5]|3[689]|6011|65|64[4-9]|35)"
COUNTRY_CODES = r"^\+?(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
RESERVED_NETWORKS = r"^(?:0|127|22[4-9]|2[3-5][0-9])\."
CUES = {
    "email": r"(?i)\b(?:e-?mail|mailto|contact|write to|reach)\b",
    "ip": r"(?i)\b(?:ip|host|server|address|client|login from|ping)\b",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|payment|pan)\b",
    "phone": r"(?i)\b(?:phone|tel|call|fax|mobile|cell|whatsapp)\b",
}
AGAINST = r"(?i)\b(?:version|release|section|chapter|isbn|issn|order|invoice|ticket|serial|sku|sha|md5|hash|uuid|build)\b"

#: Characters before a candidate in which cue words are looked for.
CONTEXT = 40
ACCEPT = 0.5
LABELERS = ("form", "list", "context", "edge")
#: Each labeler's chance to vote rightly: first guess, least and greatest. A number that fails its check digits is hardly
#: ever a card, and a fitting number range or clean edges are never more than weak evidence, whatever agrees with them.
CHANCES = ((0.9, 0.85, 0.93), (0.6, 0.5, 0.65), (0.9, 0.85, 0.97), (0.6, 0.5, 0.65))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda a, i: a
        + F.when((F.length(digits) - i) % 2 == 0, F.substring(digits, i, F.lit(1)).cast("int")).otherwise(
            F.get(F.array(*[F.lit(2 * d % 10 + 2 * d // 10) for d in range(10)]), F.substring(digits, i, F.lit(1)).cast("int"))
        ),
    )
    return total % 10 == 0


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def passes(kind: str, match: Column) -> Column:
    """The base check of a match."""
    if kind == "ip":
        # A part's value shows in its last three digits once leading zeros are off.
        small = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.right(p, F.lit(3)).cast("int") <= 255)
        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        n = F.length(digits_of(match))
        return F.when(n.between(13, 19), luhn(digits_of(match))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits_of(match)).between(9, 15)
    return F.lit(True)


def located(docs: DataFrame, name: str, pattern: str, needs: str | None) -> DataFrame:
    """`docs` with the column `name`: every match of a pattern in `text` as struct(start, end, match, before, after), places
    in code points. Steps are columns of their own, so that none is computed twice."""
    text, m, p = F.col("text"), f"m_{name}", f"p_{name}"
    present = F.contains(text, F.lit(needs)) if needs else text.rlike("[0-9]")
    docs = docs.withColumn(m, F.when(present, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))
    # What lies before, between and after the matches: the lengths give the places.
    docs = docs.withColumn(p, F.when(F.size(F.coalesce(m, F.array().cast("array<string>"))) > 0, F.split(text, pattern, -1)))

    def step(a: Column, i: Column) -> Column:
        start = a["at"] + F.length(F.get(p, i))
        end = start + F.length(F.get(m, i))
        found = F.struct(
            start.alias("start"), end.alias("end"), F.get(m, i).alias("match"),
            F.substring(F.get(p, i), -CONTEXT, CONTEXT).alias("before"), F.substring(F.get(p, i + 1), 1, 1).alias("after"),
        )
        return F.struct(end.alias("at"), F.concat(a["out"], F.array(found)).alias("out"))

    none = F.array().cast("array<struct<start:int,end:int,match:string,before:string,after:string>>")
    walked = F.aggregate(F.sequence(F.lit(0), F.size(m) - 1), F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda a: a["out"])
    return docs.withColumn(name, F.when(F.col(p).isNotNull(), walked).otherwise(none)).drop(m, p)


def votes(kind: str, found: Column, valid: Column) -> Column:
    """Each labeler's vote on a candidate: 1 for, -1 against, 0 neither."""
    match, before, after = found["match"], found["before"], found["after"]
    digits = digits_of(match)
    if kind == "email":
        ending = F.lower(F.regexp_extract(match, r"([A-Za-z0-9-]+)$", 1))
        listed = F.when(ending.isin(*DOMAIN_ENDS), 1).otherwise(-1)
    elif kind == "ip":
        listed = F.when(match.rlike(RESERVED_NETWORKS), -1).otherwise(1)
    elif kind == "card":
        listed = F.when(digits.rlike(CARD_PREFIXES), 1).otherwise(-1)
    else:
        listed = F.when(match.rlike(COUNTRY_CODES), 1).otherwise(0)
    context = F.when(before.rlike(AGAINST), -1).when(before.rlike(CUES[kind]), 1).otherwise(0)
    edge = F.when(before.rlike(r"[\p{L}\p{N}=#/\"']$") | after.rlike(r"^[\p{L}\p{N}\"']"), -1).otherwise(1)
    form = F.when(valid, 1).otherwise(-1)
    return F.struct(*[v.cast("int").alias(n) for n, v in zip(LABELERS, (form, listed, context, edge), strict=True)])


def overlaps(spans: Column, start: Column, end: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < end) & (start < s["end"]))


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, spans): the candidates of each text as struct(kind number, start, end, base, votes), by kind and start."""
    out = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    for kind in KINDS:
        out = located(out, f"b_{kind}", BASE[kind], NEEDS.get(kind))
        if kind in LOOSE:
            out = located(out, f"l_{kind}", LOOSE[kind], NEEDS_LOOSE.get(kind))

    def judged(kind: str, column: str, base: bool) -> Column:
        def one(f: Column) -> Column:
            valid = passes(kind, f["match"]) if base else F.lit(False)
            return F.struct(
                F.lit(KINDS.index(kind)).alias("kind"), f["start"].alias("start"), f["end"].alias("end"),
                valid.alias("base"), votes(kind, f, valid if base else F.lit(True)).alias("votes"),
            )

        rows = F.transform(column, one)
        if kind == "card":  # numbers of other lengths are no candidates
            rows = F.transform(F.filter(column, lambda f: F.length(digits_of(f["match"])).between(13, 19)), one)
        return rows

    # Only matches that pass their check keep others out: the raw card pattern fits any two neighbouring digits.
    passing = lambda kind: F.filter(f"b_{kind}", lambda f: passes(kind, f["match"]))
    base = F.concat(*[passing(k) for k in KINDS])
    spans = []
    for kind in KINDS:
        spans.append(judged(kind, f"b_{kind}", True))
        if kind in LOOSE:
            spans.append(F.filter(judged(kind, f"l_{kind}", False), lambda s: ~overlaps(base, s["start"], s["end"])))
    return out.select("doc_id", F.array_sort(F.concat(*spans)).alias("spans"))


def sigmoid(x: float) -> float:
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, x))))


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 50) -> tuple[list[float], list[float]]:
    """EM for one kind: each labeler's chance to vote rightly when it votes, within CHANCES, and each pattern's posterior."""
    right, prior = [first for first, _, _ in CHANCES], 0.5
    posterior: list[float] = []
    for _ in range(rounds):
        posterior = []
        for pattern, _ in patterns:
            odds = math.log(prior / (1 - prior)) + sum(v * math.log(r / (1 - r)) for v, r in zip(pattern, right, strict=True))
            posterior.append(sigmoid(odds))
        total = sum(n for _, n in patterns)
        prior = min(0.7, max(0.3, (sum(p * n for p, (_, n) in zip(posterior, patterns, strict=True)) + 1) / (total + 2)))
        for j in range(len(LABELERS)):
            voted = sum(n for v, n in patterns if v[j])
            agreed = sum(n * (p if v[j] > 0 else 1 - p) for p, (v, n) in zip(posterior, patterns, strict=True) if v[j])
            first, least, most = CHANCES[j]
            right[j] = min(most, max(least, (agreed + 10 * first) / (voted + 10)))
    return right, posterior


def classifier(patterns: list[tuple[tuple[int, ...], int]], posterior: list[float], steps: int = 400) -> list[float]:
    """Logistic regression of the posteriors on the votes: bias and one weight per labeler. Counts enter by their
    logarithm, so that one very common pattern doesn't decide alone."""
    w = [0.0] * (len(LABELERS) + 1)
    mass = [math.log1p(n) for _, n in patterns]
    whole = sum(mass) or 1.0
    for _ in range(steps):
        slope = [0.01 * x for x in w]
        for (pattern, _), p, m in zip(patterns, posterior, mass, strict=True):
            x = (1, *pattern)
            gap = sigmoid(sum(a * b for a, b in zip(w, x, strict=True))) - p
            for j, value in enumerate(x):
                slope[j] += m / whole * gap * value
        w = [a - b for a, b in zip(w, slope, strict=True)]
    return w


def train(found: DataFrame) -> dict[int, list[float]]:
    """Weights by kind, from how often each pattern of votes occurs in all documents."""
    counts = found.select(F.explode("spans").alias("s")).groupBy("s.kind", *[f"s.votes.{n}" for n in LABELERS]).count()
    by_kind: dict[int, list] = {}
    for row in sorted(counts.collect()):  # at most 4 x 3^4 rows
        by_kind.setdefault(row[0], []).append((tuple(row[1:5]), row[5]))
    return {kind: classifier(patterns, reliabilities(patterns)[1]) for kind, patterns in by_kind.items()}


def find_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, spans) for each row of `docs`: spans as struct(kind, start, end, base), by kind as in KINDS and start.

    Places count code points from 0, the end is exclusive. Base spans are always there; others where the classifier says
    yes and no base span overlaps. Null and empty texts have no spans. Rows are judged alone, so repeated rows and ids
    make no difference. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    found = stored(candidates(docs), f"{scratch(spark)}/candidates")
    weights = train(found)

    def accepted(s: Column) -> Column:
        decided = F.lit(False)
        for kind, (bias, *own) in weights.items():
            score = F.lit(bias) + sum(F.lit(w) * s["votes"][n] for n, w in zip(LABELERS, own, strict=True))
            decided = F.when(s["kind"] == kind, score >= math.log(ACCEPT / (1 - ACCEPT))).otherwise(decided)
        return s["base"] | decided

    names = F.array(*[F.lit(k) for k in KINDS])
    kept = F.transform(
        F.filter("spans", accepted), lambda s: F.struct(F.get(names, s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"))
    )
    return found.select("doc_id", kept.alias("spans"))


@query("op1_pii_votes")
def op1_pii_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    written = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of_kind = lambda k: F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [of_kind(k) for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
