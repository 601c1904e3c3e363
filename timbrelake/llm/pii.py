"""Personal data: generators propose overlapping spans, boosted trees and calibrated thresholds select them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timbrelake.session import scratch_path

#: Kinds in the order in which spans are listed; the first four are the base.
KINDS = ("email", "ip", "card", "phone", "secret", "ssn")
TREES, DEPTH = 20, 3
#: Precision that a kind's threshold has to reach on the calibration part.
PRECISION = 0.9
#: Characters on either side of a span that are context.
CONTEXT = 24

SPAN = "array<struct<kind:int,start:int,end:int,match:string>>"
#: Possessive forms of the base patterns: they match the same places without recursion. A match
#: of ``email`` starts where its run of characters does or where the last match ended.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
#: Generators beyond the base: kind, pattern, texts of which one has to occur (none: any digit).
GENERATORS = (
    ("secret", r"AKIA[0-9A-Z]{8,32}", ("AKIA",)),
    ("secret", r"(?:password|passwd|token|secret|api_key|apikey) ?[=:] ?[\"']?[0-9A-Za-z_+/.-]{6,128}", ("password", "passwd", "token", "secret", "api_key", "apikey")),
    ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", ()),
    ("phone", r"\(?(?<![0-9])[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])", ()),
    ("email", r"[A-Za-z0-9._%+-]{1,64} ?[\[(]at[\])] ?[A-Za-z0-9-]{1,64} ?(?:\.|[\[(]dot[\])]) ?[A-Za-z]{2,24}", ("(at)", "[at]")),
    ("card", r"(?<![0-9])[0-9]{4}(?:[ .-]?[0-9]{4}){2}[ .-]?[0-9]{1,7}(?![0-9])", ()),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9])", ()),
)
WORDS = {
    "near_phone": "tel|phone|call|fax|mobil",
    "near_card": "card|visa|pay|iban|account",
    "near_mail": "mail|contact|write",
    "near_host": "host|server|addr|login",
    "near_secret": "pass|token|secret|key|akia",
    "near_person": "ssn|social|name|born",
}


def digits(match: str) -> str:
    return f"regexp_replace({match}, '[^0-9]', '')"


def luhn(match: str) -> str:
    """SQL: 13 to 19 digits, the doubled sum of which divides by ten."""
    d = digits(match)
    x = f"cast(substring(reverse({d}), i, 1) as int)"
    return (
        f"CASE WHEN length({d}) BETWEEN 13 AND 19 THEN aggregate(sequence(1, length({d})), 0, (s, i) -> s + "
        f"CASE WHEN i % 2 = 1 THEN {x} WHEN {x} > 4 THEN 2 * {x} - 9 ELSE 2 * {x} END) % 10 = 0 ELSE false END"
    )


def octets(match: str) -> str:
    """SQL: no part beyond 255, leading zeros apart."""
    part = "regexp_replace(p, '^0+', '')"
    return f"forall(split({match}, '[.]'), p -> length({part}) < 3 OR (length({part}) = 3 AND {part} <= '255'))"


CHECKS = {
    "email": "true",
    "ip": octets("x.match"),
    "card": luhn("x.match"),
    "phone": f"length({digits('x.match')}) BETWEEN 9 AND 15",
}


def add_spans(frame: DataFrame, name: str, kind: str, pattern: str, gate: Column, check: str = "true") -> DataFrame:
    """A column with the places of a pattern in ``_text`` that pass a check, leftmost first.

    The pieces between matches give the offsets, in code points. Texts that fail the gate are not
    searched.
    """
    found = F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))
    pieces = F.slice(F.split("_text", pattern, -1), F.lit(1), F.size(found))
    zipped = F.zip_with(found, pieces, lambda m, p: F.struct(m.alias("match"), F.length(p).alias("gap")))
    start = "acc.pos + x.gap"
    fold = (
        f"aggregate(_zipped, named_struct('pos', 0, 'out', cast(array() as {SPAN})), (acc, x) -> named_struct("
        f"'pos', {start} + length(x.match), 'out', CASE WHEN {check} THEN concat(acc.out, array(named_struct("
        f"'kind', {KINDS.index(kind)}, 'start', {start}, 'end', {start} + length(x.match), 'match', x.match))) "
        "ELSE acc.out END), acc -> acc.out)"
    )
    empty = f"cast(array() as {SPAN})"
    return (
        frame.withColumn("_zipped", F.when(gate, zipped))
        .withColumn(name, F.expr(f"CASE WHEN _zipped IS NULL OR size(_zipped) = 0 THEN {empty} ELSE {fold} END"))
        .drop("_zipped")
    )


def base_spans(docs: DataFrame) -> DataFrame:
    """Adds ``_base``: the spans of the four base kinds, by kind, then start."""
    text = F.col("_text")
    numbers = F.col("_numbers")
    out = docs.withColumn("_numbers", text.rlike("[0-9]"))
    out = add_spans(out, "_email", "email", EMAIL, text.contains("@"))
    out = add_spans(out, "_ip", "ip", IP, numbers & text.contains("."), CHECKS["ip"])
    out = add_spans(out, "_card", "card", CARD, numbers, CHECKS["card"])
    out = add_spans(out, "_phone", "phone", PHONE, text.contains("+"), CHECKS["phone"])
    return out.withColumn("_base", F.concat("_email", "_ip", "_card", "_phone"))


def candidates(docs: DataFrame) -> DataFrame:
    """Adds ``_candidates``: what the generators propose, also inside base spans, with features."""
    text, out, names = F.col("_text"), docs, []
    for k, (kind, pattern, needed) in enumerate(GENERATORS):
        gate = F.col("_numbers")
        if needed:
            gate = F.lit(False)
            for word in needed:
                gate = gate | text.contains(word)
        names.append(f"_g{k}")
        out = add_spans(out, names[-1], kind, pattern, gate)
    raw = F.concat(*names, "_email", "_ip", "_phone", "_card")
    described = F.transform(raw, lambda c: F.struct(*(c[x].alias(x) for x in ("kind", "start", "end", "match")), features(c).alias("f")))
    return out.withColumn("_candidates", F.array_distinct(described)).drop(*names)


def features(c: Column) -> Column:
    """Format and context of a candidate, as doubles in the order of :func:`feature_names`."""
    match, size = c["match"], F.length(c["match"])
    n_digits = F.length(F.regexp_replace(match, "[^0-9]", ""))
    before = F.lower(F.substring(F.col("_text"), F.greatest(c["start"] + 1 - CONTEXT, F.lit(1)), F.least(c["start"], F.lit(CONTEXT))))
    after = F.substring(F.col("_text"), c["end"] + 1, F.lit(1))
    number = F.regexp_replace(match, "[^0-9]", "")
    doubled = F.aggregate(
        F.sequence(F.lit(1), F.greatest(n_digits, F.lit(1))), F.lit(0),
        lambda s, i: s + F.coalesce(_weighed(F.substring(F.reverse(number), i, F.lit(1)), i), F.lit(0)),
    )
    own = [
        c["kind"], size, n_digits, F.length(F.regexp_replace(match, "[^A-Z]", "")), F.length(F.regexp_replace(match, "[^a-z]", "")),
        F.length(F.regexp_replace(match, "[^ .()-]", "")), F.length(F.regexp_replace(match, "[^.]", "")),
        F.size(F.array_distinct(F.split(match, ""))), (doubled % 10 == 0).cast("int"), match.startswith("+").cast("int"),
        match.contains("@").cast("int"), F.lower(match).rlike("pass|token|secret|key").cast("int"),
        before.rlike("[0-9a-z]$").cast("int"), after.rlike("[0-9A-Za-z]").cast("int"),
    ]
    own += [before.rlike(words).cast("int") for words in WORDS.values()]
    return F.array(*(F.coalesce(x.cast("double"), F.lit(0.0)) for x in own))


def _weighed(digit: Column, i: Column) -> Column:
    value = F.when(digit.rlike("[0-9]"), digit).cast("int")
    twice = F.when(value > 4, 2 * value - 9).otherwise(2 * value)
    return F.when(i % 2 == 1, value).otherwise(twice)


def feature_names() -> list[str]:
    form = "kind size digits upper lower separators dots distinct luhn plus at word joined_left joined_right"
    return [*form.split(), *WORDS]


def weak_label(c: Column) -> Column:
    """What is known of a candidate from its form alone: 1, 0, or null where nothing is."""
    match, kind = c["match"], c["kind"]
    at = {k: kind == i for i, k in enumerate(KINDS)}
    number = F.regexp_replace(match, "[^0-9]", "")
    ok_octets = F.forall(F.split(match, "[.]"), lambda p: F.regexp_replace(p, "^0+", "").rlike("^(?:|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    key = match.rlike("^AKIA[0-9A-Z]{16}$") | match.rlike("[=:] ?[\"']?[0-9A-Za-z_+/-]{12,}")
    return (
        F.when(at["email"], match.contains("@").cast("int"))
        .when(at["ip"], ok_octets.cast("int"))
        .when(at["card"], (F.length(number).between(13, 19) & (c["f"][feature_names().index("luhn")] == 1)).cast("int"))
        .when(at["phone"], F.when(match.startswith("+"), F.length(number).between(9, 15).cast("int")).when(c["f"][feature_names().index("near_phone")] == 1, F.lit(1)))
        .when(at["secret"], key.cast("int"))
        .when(at["ssn"], (~match.rlike("^(?:000|666|9)|-00-|-0000$")).cast("int"))
    )


@dataclass
class Selector:
    """Trees as column expressions with their calibration, and the least chance that each kind needs."""

    trees: list
    weights: list[float]
    slope: float
    intercept: float
    thresholds: dict[int, float]

    def chance(self, f: Column) -> Column:
        margin = sum((w * tree_value(t, f) for w, t in zip(self.weights, self.trees)), F.lit(0.0))
        return 1 / (1 + F.exp(-(margin * self.slope + self.intercept)))

    def accepts(self, c: Column) -> Column:
        ok = F.lit(False)
        for kind, least in sorted(self.thresholds.items()):
            ok = F.when(c["kind"] == kind, c["chance"] >= least).otherwise(ok)
        return ok


def tree_value(node, f: Column) -> Column:
    """A fitted tree (feature, threshold, left, right), or a leaf's number, as nested conditions."""
    if not isinstance(node, tuple):
        return F.lit(float(node))
    feature, threshold, left, right = node
    return F.when(f[feature] <= threshold, tree_value(left, f)).otherwise(tree_value(right, f))


def _nodes(node) -> object:
    if node.subtreeDepth() == 0:
        return node.prediction()
    split = node.split()
    return split.featureIndex(), split.threshold(), _nodes(node.leftChild()), _nodes(node.rightChild())


def proposed(docs: DataFrame) -> DataFrame:
    """Base spans and candidates of every row, written to the shared folder so that texts are searched once."""
    spark = docs.sparkSession
    path = scratch_path(spark, "spans")
    candidates(base_spans(docs)).drop("_text", "_numbers").write.parquet(path)
    return spark.read.parquet(path)


def fit(spans: DataFrame) -> Selector | None:
    """Train and calibrate on the candidates of all rows of :func:`proposed`.

    Seven tenths of the candidates train the trees; on the rest a logistic curve turns margins
    into chances and each kind gets the least chance at which the weak labels reach PRECISION.
    Kinds that never do so are not accepted. Without candidates of both labels there is nothing
    to learn and the result is None.
    """
    spark = spans.sparkSession
    found = spans.select(F.explode("_candidates").alias("c"))
    rows = found.select("c.kind", weak_label(F.col("c")).cast("double").alias("label"), *(
        F.col("c.f")[i].alias(n) for i, n in enumerate(feature_names()) if n != "kind"
    ), F.pmod(F.xxhash64("c.match", "c.start"), F.lit(10)).alias("part")).where("label is not null")
    path = scratch_path(spark, "candidates")
    rows.withColumn("kind", F.col("kind").cast("double")).write.parquet(path)
    table = VectorAssembler(inputCols=feature_names(), outputCol="features").transform(spark.read.parquet(path))
    learned, kept = table.where("part < 7"), table.where("part >= 7")
    if learned.select("label").distinct().count() < 2 or kept.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7).fit(learned)
    trees = [_nodes(t._java_obj.rootNode() if hasattr(t, "_java_obj") else t.rootNode()) for t in model.trees]
    weights = list(model.treeWeights)
    margin = sum((w * tree_value(t, vector_to_array("features")) for w, t in zip(weights, trees)), F.lit(0.0))
    scored = kept.select("kind", "label", margin.alias("margin"))
    curve = LogisticRegression(regParam=1e-3).fit(VectorAssembler(inputCols=["margin"], outputCol="features").transform(scored))
    slope, intercept = float(curve.coefficients[0]), float(curve.intercept)
    chance = 1 / (1 + F.exp(-(F.col("margin") * slope + intercept)))
    steps = scored.groupBy("kind", F.round(chance, 3).alias("chance")).agg(F.sum("label").alias("good"), F.count("*").alias("n")).collect()
    thresholds = {}
    for kind in {int(r.kind) for r in steps}:
        good = n = 0.0
        for r in sorted((r for r in steps if int(r.kind) == kind), key=lambda r: -r.chance):
            good, n = good + r.good, n + r.n
            if good / n >= PRECISION and r.chance >= 0.5:
                thresholds[kind] = max(r.chance - 0.0005, 0.5)
    return Selector(trees, weights, slope, intercept, thresholds)


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every row.

    Base spans are found by their patterns and checks. Candidates of the generators that do not
    meet a base span are added if the trees accept them; of added spans that overlap the one with
    the greater chance stays, then the earlier, then the longer. Spans are kind:start:end in code
    points, end exclusive, by kind in the order of KINDS, then start. Null and empty texts have no
    spans (an empty list, whose hash is that of the empty string). Repeated rows and null ids
    stay; other columns are ignored; an empty table gives no rows. Trees and thresholds learn from
    the candidates of every row. Texts are searched once, by column expressions; what is found is
    written to the shared folder, from where training and selection, which needs no shuffle, read it.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("_text"))
    out = proposed(plain)
    selector = fit(out)
    if selector is None or not selector.thresholds:
        out = out.withColumn("_added", F.expr(f"cast(array() as {SPAN})"))
    else:
        apart = F.filter("_candidates", lambda c: ~F.exists("_base", lambda b: (c["start"] < b["end"]) & (b["start"] < c["end"])))
        scored = F.transform(apart, lambda c: F.struct(
            *(c[x].alias(x) for x in ("kind", "start", "end", "match")), selector.chance(c["f"]).alias("chance")
        ))
        out = out.withColumn("_scored", F.when(F.size("_candidates") > 0, scored))
        accepted = F.filter("_scored", selector.accepts)
        ordered = F.array_sort(F.transform(accepted, lambda c: F.struct((-c["chance"]).alias("rank"), *(c[x].alias(x) for x in ("start", "end", "kind", "match")))))
        out = out.withColumn("_ordered", ordered)
        overlap = "exists(kept, k -> c.start < k.end AND k.start < c.end)"
        pick = (
            f"aggregate(_ordered, cast(array() as {SPAN}), (kept, c) -> CASE WHEN {overlap} THEN kept ELSE "
            "concat(kept, array(named_struct('kind', c.kind, 'start', c.start, 'end', c.end, 'match', c.match))) END)"
        )
        out = out.withColumn("_added", F.expr(f"CASE WHEN _ordered IS NULL THEN cast(array() as {SPAN}) ELSE {pick} END"))
    names = F.array(*(F.lit(k) for k in KINDS))

    def listed(column: Column) -> Column:
        return F.array_join(F.transform(column, lambda c: F.concat_ws(":", F.element_at(names, c["kind"] + 1), c["start"], c["end"])), ",")

    every = F.array_sort(F.concat("_base", "_added"))
    return out.select(
        "doc_id", *(F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS[:4]),
        F.sha2(listed(F.col("_base")), 256).alias("base_sha256"), listed(every).alias("spans"),
    )
