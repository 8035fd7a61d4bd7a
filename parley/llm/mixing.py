"""Mixing sources to target weights with soft membership: DataFrame functions only.

1. A naive Bayes classifier over hashed distinct words, fitted on the labelled table's documents, gives every document
   posteriors p_dk over domains. The log-likelihood table has BUCKETS rows, so it is broadcast.
2. Rates r_d >= 0 minimise sum_k (sum_d r_d n_d p_dk / N - t_k)^2 / s_k, where n_d are tokens, N their sum, t_k the
   target and s_k the present share of domain k: distributed projected gradient with momentum, from r_d = 1. Its step length
   is 1, since the scaled Gram matrix has row sums of 1. An iteration is one aggregation of as many sums as there are
   domains; a document's rate is a fold over the gradients since it was last written, every FOLD iterations, so nothing
   but those few numbers goes to the driver.

Tokens are words between white space: the tokenizers at hand run in Python only, which this operator does without.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Workspace, ascii_lower, table

BUCKETS, SAMPLE, DOMAINS = 4096, 16_384, 64
#: An iteration ends the fit if all totals are this close to the targets, or if STALL of them have not lowered the sum of
#: squares by that share: the targets can't be met then, as with too few documents of a domain.
STEPS, FOLD, CLOSE, STALL, LOWER = 200, 8, 1e-4, 5, 1e-2
POWER = 0.7
SCALE = 1024


def words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int")


def fit_domains(labelled: DataFrame) -> tuple[list[str], list[float], DataFrame]:
    """`labelled(text, domain)` -> names, log priors and `bucket, l0, l1, ..`: scaled log-likelihoods. Rows without a
    domain don't count. There may be at most DOMAINS domains."""
    known = labelled.filter("domain IS NOT NULL")
    sizes = known.groupBy("domain").count().orderBy("domain").limit(DOMAINS + 1).collect()
    if len(sizes) > DOMAINS:
        raise ValueError(f"over {DOMAINS} domains")
    names, n = [r["domain"] for r in sizes], sum(r["count"] for r in sizes)
    if not names:
        return [], [], None
    seen = known.select("domain", F.explode(F.array_distinct(words(F.col("text")))).alias("w")).select("domain", bucket(F.col("w")).alias("bucket"))
    counts = seen.groupBy("bucket").agg(*[F.count_if(F.col("domain") == d).alias(f"c{k}") for k, d in enumerate(names)])
    counts = labelled.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left").na.fill(0)
    totals = counts.agg(*[F.sum(f"c{k}").alias(f"n{k}") for k in range(len(names))])
    levels = [
        F.round(F.log((F.col(f"c{k}") + 1.0) / (F.col(f"n{k}") + float(BUCKETS))) * SCALE).cast("long").alias(f"l{k}") for k in range(len(names))
    ]
    priors = [SCALE * log(r["count"] / n) for r in sizes]
    return names, priors, counts.join(F.broadcast(totals)).select("bucket", *levels)


def posteriors(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """`doc_id, n_tokens` and `p`, the posteriors in the order of the names. A text without words has the priors."""
    names, priors, levels = model
    ks = range(len(names))
    split = docs.select("doc_id", F.monotonically_increasing_id().alias("rid"), words(F.col(text_col)).alias("w"))
    split = split.select("rid", "doc_id", F.size("w").cast("long").alias("n_tokens"), F.array_distinct("w").alias("w"))
    each = split.select("rid", "doc_id", "n_tokens", F.explode_outer("w").alias("w")).withColumn("bucket", bucket(F.col("w")))
    each = each.withColumn("bucket", F.when(F.col("w").isNotNull(), F.col("bucket")))
    sums = each.join(F.broadcast(levels), "bucket", "left").groupBy("rid", "doc_id", "n_tokens").agg(
        *[F.coalesce(F.sum(f"l{k}"), F.lit(0)).alias(f"s{k}") for k in ks]
    )
    scores = [F.col(f"s{k}") + F.lit(priors[k]) for k in ks]
    top = F.greatest(*scores) if len(names) > 1 else scores[0]
    odds = F.array(*[F.exp((s - top) / SCALE) for s in scores])
    whole = sums.select("doc_id", "n_tokens", odds.alias("o"))
    total = F.aggregate("o", F.lit(0.0), lambda a, x: a + x)
    return whole.select("doc_id", "n_tokens", F.transform("o", lambda x: x / total).alias("p"))


def tempered(shares: list[float], power: float = POWER) -> list[float]:
    raised = [s**power if s > 0 else 0.0 for s in shares]
    return [x / sum(raised) for x in raised] if sum(raised) else raised


def weights_of(table: dict[str, float], names: list[str]):
    """Target weights of a table by domain, as a function of the present shares: domains that are not in it keep their
    share, and the others have what is left in the proportions of the table."""

    def targets(shares: list[float]) -> list[float]:
        rest = 1 - sum(s for d, s in zip(names, shares, strict=True) if d not in table)
        total = sum(table[d] for d in names if d in table)
        return [table[d] / total * rest if d in table and total else s for d, s in zip(names, shares, strict=True)]

    return targets


def fit_rates(work: Workspace, rows: DataFrame, targets, least: float = 0.0, keep_total: bool = True, steps: int = STEPS):
    """`rows(n_tokens, p, ..)` -> (the rows with `rate`, shares, targets, totals reached).

    `targets(shares)` gives the weight of each domain. With `keep_total` the tokens stay as many as they are; else
    the total is the smallest at which no domain needs to shrink. Without tokens there is nothing to fit: all rates are 1.
    """
    k = len(rows.select("p").first()["p"]) if rows.take(1) else 0
    n = F.col("n_tokens").cast("double")
    first = rows.agg(F.sum(n), *[F.sum(n * F.get("p", i)) for i in range(k)]).first()
    total = first[0] or 0.0
    if not total:
        return rows.withColumn("rate", F.lit(1.0)), [0.0] * k, [0.0] * k, [0.0] * k
    shares = [x / total for x in first[1:]]
    goal = targets(shares)
    if not keep_total:
        grow = max(s / w for s, w in zip(shares, goal, strict=True) if w > 0)
        goal = [w * grow for w in goal]
    held = rows.select(*[F.col(c) for c in rows.columns], F.lit(1.0).alias("r"), F.lit(1.0).alias("was"))
    history: list[tuple[float, list[float]]] = []
    best, stalled, momentum, written = float("inf"), 0, 1.0, 0
    reached = shares
    for step in range(steps + 1):
        now = stepped(history, least)
        ahead = (momentum - 1) / (momentum + 2)
        y = now["r"] + F.lit(ahead) * (now["r"] - now["was"])
        sums = held.select("n_tokens", "p", now["r"].alias("r"), y.alias("y"))
        sums = sums.agg(*[F.sum(n * F.col("r") * F.get("p", i)) for i in range(k)], *[F.sum(n * F.col("y") * F.get("p", i)) for i in range(k)]).first()
        reached, looked = [x / total for x in sums[:k]], [x / total for x in sums[k:]]
        loss = sum((r - t) ** 2 / max(s, 1e-12) for r, t, s in zip(reached, goal, shares, strict=True))
        stalled = 0 if loss < best * (1 - LOWER) else stalled + 1
        momentum = momentum + 1 if loss <= best else 1.0  # begins anew where it has overshot
        best = min(best, loss)
        if step == steps or stalled > STALL or all(abs(r - t) <= CLOSE * t or t <= 0 and r < CLOSE for r, t in zip(reached, goal, strict=True)):
            break
        history.append((ahead, [(y - t) / max(s, 1e-12) for y, t, s in zip(looked, goal, shares, strict=True)]))
        if len(history) == FOLD:
            now = stepped(history, least)
            held = work.write(held.withColumn("now", now).select(*rows.columns, "now.r", "now.was"), f"rates{written}")
            if written:
                work.drop(f"rates{written - 1}")
            history, written = [], written + 1
    return held.withColumn("rate", stepped(history, least)["r"]).drop("r", "was"), shares, goal, reached


def stepped(history: list[tuple[float, list[float]]], least: float) -> Column:
    """`r, was`: a document's rate after the steps, and that before the last one."""
    start = F.struct(F.col("r").alias("r"), F.col("was").alias("was"))
    if not history:
        return start
    steps = F.array(*[F.struct(F.lit(float(ahead)).alias("ahead"), F.array(*[F.lit(float(x)) for x in g]).alias("g")) for ahead, g in history])

    def step(x, s):
        down = F.aggregate(F.zip_with(F.col("p"), s["g"], lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)
        return F.struct(F.greatest(F.lit(float(least)), x["r"] + s["ahead"] * (x["r"] - x["was"]) - down).alias("r"), x["r"].alias("was"))

    return F.aggregate(steps, start, step)


def copies(rate: Column, doc_id: Column) -> Column:
    """The rate rounded up or down by a hash of the id, so that counts match the rates on the whole and repeats agree."""
    part = F.pmod(F.xxhash64(F.lit("copies"), doc_id), F.lit(1 << 20)) / F.lit(float(1 << 20))
    return F.floor(rate + part).cast("long")


def mix(docs: DataFrame, labels: DataFrame, targets=tempered, domain_col: str = "lang", least: float = 0.0, keep_total: bool = True) -> DataFrame:
    """`doc_id, n_tokens, domain, posterior, rate, copies, domain_target, domain_reached`, one row per row of
    `docs(doc_id, text, <domain_col>)`.

    `targets` is a table of weights by domain, or a function of the domains' present shares. Domains are those of the
    documents in `labels` (at most SAMPLE of them, by hash of the id); `domain_col` of other documents is not read.
    `domain` is the likeliest, the first by name of equals; `domain_target` and `domain_reached` are its tokens as shares
    of all that there are now, so a fit that could not meet a target shows. Null texts have no tokens and get the priors.
    Null ids never are labelled; repeated rows stay. Without labelled documents there are no domains: null domain and
    targets, empty posterior, rate 1.
    """
    work = Workspace(docs.sparkSession, "mixing")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(domain_col).cast("string").alias("domain"))
    picked = labels.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    labelled = work.write(rows.join(F.broadcast(picked), "doc_id", "left_semi").select("text", "domain"), "labelled")
    names, priors, levels = fit_domains(labelled)
    null = F.lit(None).cast("double")
    if not names:
        tokens = rows.select("doc_id", F.size(words(F.col("text"))).cast("long").alias("n_tokens"))
        empty = F.array().cast("array<double>")
        return tokens.select("*", F.lit(None).cast("string").alias("domain"), empty.alias("posterior"), F.lit(1.0).alias("rate"), F.lit(1).cast("long").alias("copies"), null.alias("domain_target"), null.alias("domain_reached"))
    soft = work.write(posteriors(rows.select("doc_id", "text"), (names, priors, work.write(levels, "levels"))), "soft")
    fitted, _, goal, reached = fit_rates(work, soft, weights_of(targets, names) if isinstance(targets, dict) else targets, least, keep_total)
    best = F.array_position("p", F.array_max("p")).cast("int")
    each = lambda values: F.element_at(F.array(*[F.lit(x) for x in values]), best)
    rated = fitted.select("doc_id", "n_tokens", each(names).alias("domain"), F.col("p").alias("posterior"), "rate", copies(F.col("rate"), F.col("doc_id")).alias("copies"))
    by_name = F.array_position(F.array(*map(F.lit, names)), F.col("domain")).cast("int")
    at = lambda values: F.element_at(F.array(*[F.lit(float(x)) for x in values]), by_name)
    return rated.withColumns({"domain_target": at(goal), "domain_reached": at(reached)})


#: Target shares of the corpus's tokens.
WEIGHTS = {"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2}


def op10_source_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), WEIGHTS)
