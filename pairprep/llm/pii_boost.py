"""Personal data by candidate gradient boosting, in DataFrame expressions and Spark ML only.

Strict base kinds are found by their patterns and checks and always stay. Beside them high-recall
generators of three forms (around an at sign, groups of digits, account numbers) propose overlapping
spans; boosted trees judge each by its format and context, and a calibrated threshold per form selects
further spans, of kind `pii`.

The labels are evidence that neither the base patterns nor the features use: check digits modulo 97
for account numbers, cue words shortly before the other forms. A cue is not always there, so the base
matches, which are known to be personal data, tell how often it is: a set of further candidates is as
precise as its share with evidence is to theirs (at least CUE_SHARE, so that chance cues count for
nothing; all of it for a form without base matches). The threshold of a form is the lowest score whose
candidates reach PRECISION in that sense; base matches themselves are held out of these counts.

The trees are fitted on three quarters of at most TRAIN_DOCS documents (those with the smallest hash of
their id); the thresholds come from counts over all other documents. The fitted trees become one
nested expression.

Patterns match from the start of a run of their characters and take it whole, with possessive
quantifiers, so no text makes them slow or deep.

Defined results: a null or empty text has no spans; repeated rows get equal spans; where the
sample holds no candidate with evidence, or none without, nothing is added; other columns are kept, one named spans is replaced; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAIN_DOCS = 20_000
TREES = 10
DEPTH = 3
SEED = 42
PRECISION = 0.9
# A cue counts as usual for a form from this share of its base matches on.
CUE_SHARE = 0.5
SPAN = "array<struct<kind:string,start:bigint,end:bigint>>"

# The base patterns. A run of local-part characters is only entered at its start or
# where the last match ended, and chains of fewer than 16 digits are left out at once.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# High-recall generators: anything around an at sign, long groups of digits, account numbers.
AROUND_AT = r"(?:\G|(?<![^\s@<>()\[\],;:\"]))[^\s@<>()\[\],;:\"]++(?:@|[(\[]at[)\]])[^\s@<>()\[\],;:\"]++"
DIGITS = r"[+(]?(?<![0-9])[0-9](?:[\x20().\-/]{0,2}[0-9]){6,}+"
ACCOUNT = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}+(?:\x20?[0-9]{1,3}+(?![A-Za-z0-9]))?+"
# Cue words, whole words in either case.
MAIL_CUES = r"(?i)\b(?:e-?mails?|mails?|mailto|contact|write|reach)\b"
NUMBER_CUES = r"(?i)\b(?:phones?|telephone|tel|call|fax|mobile|cards?|visa|mastercard)\b"

Check = Callable[[Column], Column]


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def small_parts(m: Column) -> Column:
    """All dotted parts at most 255, whatever their leading zeros."""

    def small(part: Column) -> Column:
        number = F.regexp_replace(part, "^0+", "")
        return (F.length(number) <= 3) & (F.coalesce(number.try_cast("int"), F.lit(0)) <= 255)

    return F.forall(F.split(m, r"\."), small)


def luhn(m: Column) -> Column:
    """16 to 19 digits whose check sum, every second from the right doubled, ends in zero."""
    digits = F.reverse(digits_of(m))
    n = F.length(digits)

    def part(i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), n), part), F.lit(0), lambda a, b: a + b)
    return (n >= 16) & (n <= 19) & (total % 10 == 0)


def modulo_97(m: Column) -> Column:
    """Check digits of account numbers: the first four characters moved to the end, letters read as
    10 to 35, leave 1."""
    plain = F.replace(m, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))

    def grown(rest: Column, c: Column) -> Column:
        number = F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return (rest * F.when(number > 9, 100).otherwise(10) + number) % 97

    return F.aggregate(F.regexp_extract_all(turned, F.lit("[A-Z0-9]"), F.lit(0)), F.lit(0), grown) == 1


def phone_digits(m: Column) -> Column:
    return F.length(digits_of(m)).between(8, 15)


# kind, pattern, what a text must contain for the pattern to be tried, check of a match
BASE: tuple[tuple[str, str, Check, Check], ...] = (
    ("email", EMAIL, lambda t: F.contains(t, F.lit("@")), lambda m: F.lit(True)),
    ("ip", IP, lambda t: t.rlike(r"[0-9]\.[0-9]"), small_parts),
    ("card", CARD, lambda t: t.rlike(r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]"), luhn),
    ("phone", PHONE, lambda t: F.contains(t, F.lit("+")), phone_digits),
)
KINDS = tuple(kind for kind, *_ in BASE)
# pattern, what a text must contain for it, evidence from a match and the text before it
GENERATORS: tuple[tuple[str, Check, Callable[[Column, Column], Column]], ...] = (
    (AROUND_AT, lambda t: t.rlike(r"@|[(\[]at[)\]]"), lambda m, before: before.rlike(MAIL_CUES)),
    (DIGITS, lambda t: t.rlike(r"[0-9][^\p{L}]{0,2}[0-9][^\p{L}]{0,2}[0-9]"), lambda m, before: before.rlike(NUMBER_CUES)),
    (ACCOUNT, lambda t: t.rlike(r"[A-Z]{2}[0-9]{2}"), lambda m, before: modulo_97(m)),
)


def find_all(text: Column, pattern: str, worth: Column) -> Column:
    """(start, end, m) of all matches in code points; what lies between them gives the places."""
    kind = "array<struct<start:bigint,end:bigint,m:string>>"
    form = f"struct<at:bigint,found:{kind}>"
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m")
    )

    def put(done: Column, piece: Column) -> Column:
        start = done["at"] + F.length(piece["gap"])
        end = start + F.length(F.coalesce(piece["m"], F.lit("")))
        one = F.struct(start.alias("start"), end.alias("end"), piece["m"].alias("m"))
        found = F.when(piece["m"].isNotNull(), F.array_append(done["found"], one)).otherwise(done["found"])
        return F.struct(end.alias("at"), found.alias("found")).cast(form)

    begin = F.struct(F.lit(0).alias("at"), F.array().alias("found")).cast(form)
    return F.when(worth, F.aggregate(pieces, begin, put, lambda done: done["found"])).otherwise(F.array().cast(kind))


def base_spans(text: Column) -> Column:
    """Base spans by kind as listed, then start."""

    def of(kind: str, pattern: str, worth: Check, holds: Check) -> Column:
        hits = F.filter(find_all(text, pattern, worth(text)), lambda x: holds(x["m"]))
        return F.transform(hits, lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

    return F.concat(*[of(*rule) for rule in BASE]).cast(SPAN)


FEATURES = (
    "form length digits letters others at plus dots spaces dashes groups glued_before glued_after upper".split()
)


def candidates(text: Column, labelled: bool = False) -> Column:
    """(start, end, form, x) of all proposed spans, form being the number of the generator; x has the
    features; labelled ones carry their evidence too."""
    count = lambda m, chars: F.length(m) - F.length(F.regexp_replace(m, chars, ""))

    def described(c: Column, form: int, evidence: Callable[[Column, Column], Column]) -> Column:
        m = c["m"]
        before = F.substring(text, F.greatest(c["start"] - 23, F.lit(1)).cast("int"), F.least(c["start"], F.lit(24)).cast("int"))
        after = F.substring(text, (c["end"] + 1).cast("int"), F.lit(1))
        values = {
            "form": F.lit(form),
            "length": F.length(m),
            "digits": count(m, "[0-9]"),
            "letters": count(m, r"\p{L}"),
            "others": count(m, r"[^0-9\p{L}]"),
            "at": F.contains(m, F.lit("@")).cast("int"),
            "plus": m.startswith("+").cast("int"),
            "dots": count(m, r"\."),
            "spaces": count(m, " "),
            "dashes": count(m, "-"),
            "groups": F.size(F.split(m, "[^0-9]+")),
            "glued_before": before.rlike(r"[\p{L}0-9]\z").cast("int"),
            "glued_after": after.rlike(r"[\p{L}0-9]").cast("int"),
            "upper": count(m, "[A-Z]"),
        }
        x = F.struct(*[values[f].cast("double").alias(f) for f in FEATURES])
        label = [evidence(m, before).alias("evidence")] if labelled else []
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), F.lit(form).alias("form"), x.alias("x"), *label)

    def of(form: int, pattern: str, worth: Check, evidence: Callable[[Column, Column], Column]) -> Column:
        return F.transform(find_all(text, pattern, worth(text)), lambda c: described(c, form, evidence))

    return F.concat(*[of(form, *rule) for form, rule in enumerate(GENERATORS)])


def overlaps(c: Column, spans: Column) -> Column:
    return F.exists(spans, lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"]))


@dataclass(frozen=True)
class Booster:
    """Trees as nested (feature, threshold, left, right) or a number, their weights, and by form
    the score from which a candidate counts; no trees accept nothing."""

    trees: tuple
    weights: tuple[float, ...]
    thresholds: tuple[float, ...]

    def score(self, x: Column) -> Column:
        """Probability from the weighted sum of the trees."""

        def value(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            feature, threshold, left, right = node
            return F.when(x[feature] <= threshold, value(left)).otherwise(value(right))

        total = F.lit(0.0)
        for tree, weight in zip(self.trees, self.weights):
            total = total + value(tree) * F.lit(weight)
        return 1 / (1 + F.exp(-2 * total))


    def accepts(self, c: Column) -> Column:
        least = F.element_at(F.array(*[F.lit(t) for t in self.thresholds]), c["form"] + 1)
        return self.score(c["x"]) >= least


NEVER = 2.0
NOTHING = Booster((), (), (NEVER,) * len(GENERATORS))


def _nested(node) -> object:
    """A fitted Spark ML tree as nested tuples."""
    if node.subtreeDepth() == 0:
        return float(node.prediction())
    split = node.split()
    return FEATURES[split.featureIndex()], float(split.threshold()), _nested(node.leftChild()), _nested(node.rightChild())


def labelled_candidates(docs: DataFrame, text: str) -> DataFrame:
    """(c, base) of every candidate of all texts; base: it overlaps a base match."""
    value = F.col("_text")
    return (
        docs.select(F.coalesce(F.col(text), F.lit("")).alias("_text"))
        .select(base_spans(value).alias("_base"), candidates(value, True).alias("_all"))
        .select("_base", F.explode("_all").alias("c"))
        .select("c", overlaps(F.col("c"), F.col("_base")).alias("base"))
    )


def fit(docs: DataFrame, text: str = "text", train_docs: int = TRAIN_DOCS) -> Booster:
    """Fit on three of four sampled documents, calibrate on all others."""
    ids = docs.where(F.col("doc_id").isNotNull()).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_docs)
    # At most `train_docs` ids by construction.
    own = F.broadcast(ids.distinct().where(F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4)) != 0))
    rows = labelled_candidates(docs.join(own, "doc_id", "left_semi"), text).select(
        F.col("c.evidence").cast("double").alias("label"), "c.x.*"
    )
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("features", "label").persist()
    try:
        if {r["label"] for r in rows.select("label").distinct().collect()} != {0.0, 1.0}:
            return NOTHING
        model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED, maxBins=32).fit(rows)
    finally:
        rows.unpersist()
    trees = tuple(_nested(t._java_obj.rootNode()) for t in model.trees)
    fitted = Booster(trees, tuple(model.treeWeights), NOTHING.thresholds)
    hit = F.col("c.evidence").cast("long")
    # At most 1,001 rows per form.
    bins = (
        labelled_candidates(docs.join(own, "doc_id", "left_anti"), text)
        .groupBy(F.col("c.form").alias("form"), "base", F.floor(fitted.score(F.col("c.x")) * 1000).alias("bin"))
        .agg(F.count("*").alias("n"), F.sum(hit).alias("hits"))
        .collect()
    )
    return Booster(trees, fitted.weights, tuple(_calibrated([r for r in bins if r["form"] == f]) for f in range(len(GENERATORS))))


def _calibrated(bins: list) -> float:
    """The lowest score above which the further candidates of a form, given as (base, bin, n, hits),
    have evidence nearly as often as its base matches have; never, if no score does."""
    known = [r for r in bins if r["base"]]
    usual = sum(r["hits"] for r in known) / sum(r["n"] for r in known) if known else 1.0
    best, n, hits = NEVER, 0, 0
    for r in sorted((r for r in bins if not r["base"]), key=lambda r: -r["bin"]):
        n, hits = n + r["n"], hits + r["hits"]
        if hits >= PRECISION * max(usual, CUE_SHARE) * n:
            best = r["bin"] / 1000
    return best


def find_personal_data(docs: DataFrame, booster: Booster, text: str = "text") -> DataFrame:
    """Add spans: base ones by kind and start, then the further ones, which overlap no base one."""
    value = F.coalesce(F.col(text), F.lit(""))
    found = docs.drop("spans", "_base").select("*", F.inline(F.array(F.struct(base_spans(value).alias("_base")))))
    if not booster.trees:
        return found.withColumnRenamed("_base", "spans")
    chosen = F.filter(candidates(value), lambda c: booster.accepts(c) & ~overlaps(c, F.col("_base")))
    more = F.array_distinct(
        F.transform(chosen, lambda c: F.struct(F.lit("pii").alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    ).cast(SPAN)
    return found.withColumn("spans", F.concat("_base", F.array_sort(more)).cast(SPAN)).drop("_base")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every maximal run of covered characters replaced by its first kind in brackets."""
    form = "struct<at:bigint,out:array<string>>"
    by_place = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def put(done: Column, s: Column) -> Column:
        gap = F.substring(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        mark = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        grown = F.struct(s["end"].alias("at"), F.concat(done["out"], F.array(gap, mark)).alias("out")).cast(form)
        inside = F.struct(F.greatest(done["at"], s["end"]).alias("at"), done["out"].alias("out")).cast(form)
        return F.when(s["start"] >= done["at"], grown).otherwise(inside)

    begin = F.struct(F.lit(0).alias("at"), F.array().alias("out")).cast(form)

    def whole(done: Column) -> Column:
        rest = F.substring(text, (done["at"] + 1).cast("int"), F.length(text))
        return F.concat(F.array_join(done["out"], ""), rest)

    return F.when(F.size(spans) > 0, F.aggregate(by_place, begin, put, whole)).otherwise(text)


def redact(docs: DataFrame) -> DataFrame:
    """Documents with personal data replaced in `text`; n_chars follows the new text."""
    rows = docs.select(F.struct("*").alias("_row"), "text", "doc_id")
    found = find_personal_data(rows, fit(docs))
    text = redacted(F.col("text"), F.col("spans"))
    # `inline` keeps the new text from being built once per column that uses it.
    made = found.select("_row", "spans", F.inline(F.array(F.struct(text.alias("_new")))))
    size = F.when(F.size("spans") > 0, F.length("_new").cast("long")).otherwise(F.col("_row.n_chars"))
    own = {"text": F.col("_new"), "n_chars": size}
    return made.select(*[own.get(c, F.col(f"_row.{c}")).alias(c) for c in docs.columns])


def op9_pii_boost(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_personal_data(docs, fit(docs))
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(F.filter("spans", lambda s: s["kind"].isin(*KINDS))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
