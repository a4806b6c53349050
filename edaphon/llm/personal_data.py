"""Personal data: base patterns, then bootstrapped contextual extraction.

Base spans come from one regular expression per kind with its check. They are the seeds. The words
around a seed make lexical patterns (one or two words before, one after, both sides); words with a
digit or an @ that are no base span are the candidates of the kinds their shape allows, and known
non-identifiers if it allows none. A pattern's support for a kind is the trust of the different values
of that kind it surrounds, seeds counting 1; its confidence is that support over the support for all
kinds, its non-identifiers and one more for what it has not shown yet. Candidates not trusted so far
speak neither for nor against a pattern, so one that finds many unseen values is not doubted for it.
A value's trust is one minus the product of its patterns' doubts. Patterns and values are scored in
turn for a fixed number of rounds; values trusted at the end become spans wherever they stand. All of it
is expressions, joins and partial aggregations on tables of occurrences; texts are read once and never
shuffled.

Positions are code points, ends exclusive. The expressions below have no repeated groups and start
only where a match can start, so no text makes them overflow the stack or take quadratic time.

Defined cases: NULL and empty texts have no spans; equal rows get equal spans; a NULL id is a
document like any other; values found under two kinds keep the more trusted, then the first listed; an
empty table has no rows; other columns, whatever their names, are not read; long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edaphon.llm.base import materialise

# The kinds in their order.
KINDS = ("email", "ip", "card", "phone")
#: Stands for a joint inside a match, so that the expressions need no groups; same length as before.
JOINT, OTHER = "\x01", "\x02"
#: Kind of a word that cannot be an identifier.
NONE = -1

MIN_SEEDS = 3
MIN_CONFIDENCE = 0.7
MIN_TRUST = 0.8
ROUNDS = 3
CONTEXT = 100
BLOCK = 256

OCCURRENCE = "array<struct<kind:int,start:bigint,end:bigint,value:string,before:string,after:string>>"


def running_total(values: Column) -> Column:
    """Sums of all values before each one. Two levels, so that long arrays are not copied for each value."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size(values) / BLOCK).cast("int") - 1)),
        lambda b: F.slice(values, b * BLOCK + 1, BLOCK),
    )

    def before(xs: Column, first: Column) -> Column:
        start = F.struct(F.array().cast("array<bigint>").alias("all"), first.alias("sum"))
        return F.aggregate(
            xs,
            start,
            lambda a, x: F.struct(F.concat(a["all"], F.array(a["sum"])).alias("all"), (a["sum"] + x).alias("sum")),
            lambda a: a["all"],
        )

    sums = F.transform(blocks, lambda xs: F.aggregate(xs, F.lit(0).cast("bigint"), lambda a, x: a + x))
    return F.flatten(F.zip_with(blocks, before(sums, F.lit(0).cast("bigint")), before))


def matches(text: Column, pattern: str) -> Column:
    """Non-overlapping matches from the left, and the text between them."""
    return F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("between"))


def occurrences(parts: Column, kind: int, valid) -> Column:
    """``matches`` with positions and what stands around them. Arrays are passed in and zipped: a lambda that
    names an expression would evaluate it for every element."""
    found, between = parts["found"], parts["between"]
    lengths = F.zip_with(found, between, lambda m, b: (F.coalesce(F.length(m), F.lit(0)) + F.length(b)).cast("bigint"))
    ahead = F.zip_with(between, running_total(lengths), lambda b, s: F.struct(b.alias("b"), (s + F.length(b)).alias("s")))
    around = F.zip_with(F.slice(ahead, 1, F.size(found)), F.slice(between, 2, F.size(found)), lambda x, after: F.struct(x["b"], x["s"], after.alias("a")))
    rows = F.zip_with(
        found,
        around,
        lambda m, x: F.struct(
            F.lit(kind).alias("kind"),
            x["s"].alias("start"),
            (x["s"] + F.length(m)).alias("end"),
            m.alias("value"),
            F.right(x["b"], F.lit(CONTEXT)).alias("before"),
            F.left(x["a"], F.lit(CONTEXT)).alias("after"),
        ),
    )
    return F.filter(rows, lambda x: valid(x["value"]))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(number: Column) -> Column:
    """Check digit of a number of at most 20 digits."""
    padded = F.lpad(number, 20, "0")
    doubled = F.translate(padded, "0123456789", "0246813579")
    total = sum(
        (F.substring(doubled if i % 2 else padded, i, 1).cast("int") for i in range(2, 21)),
        F.substring(doubled, 1, 1).cast("int"),
    )
    return total % 10 == 0


def is_card(value: Column) -> Column:
    number = digits(value)
    return F.length(number).between(16, 19) & passes_luhn(number)


def is_ip(value: Column) -> Column:
    return value.rlike("^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\\.|$)){4}")


def is_phone(value: Column) -> Column:
    return F.length(digits(value)).between(8, 15)


def anything(value: Column) -> Column:
    return F.lit(True)


def base_matches(text: Column) -> dict[str, Column]:
    """Per kind the matches of its expression; NULL where none can be."""
    clean = F.translate(text, JOINT, OTHER)
    dots = F.regexp_replace(clean, "(?<=[A-Za-z0-9-])\\.(?=[A-Za-z0-9-])", JOINT)
    gaps = F.regexp_replace(clean, "(?<=[0-9])[ -](?=[0-9])", JOINT)
    local, host = "A-Za-z0-9._%+\\x01-", "A-Za-z0-9-"
    return {
        "email": F.when(text.contains("@"), matches(dots, f"(?:(?<![{local}])|\\G)[{local}]++@[{host}]++\\x01[{host}\\x01]+")),
        "ip": F.when(text.rlike("[0-9]\\.[0-9]"), matches(clean, "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++")),
        "card": F.when(text.rlike("[0-9][ -]?[0-9]"), matches(gaps, "[0-9][0-9\\x01]++")),
        "phone": F.when(text.contains("+"), matches(clean, "\\+[0-9][ ().0-9-]+[0-9]")),
    }


VALID = {"email": anything, "ip": is_ip, "card": is_card, "phone": is_phone}


def candidate_matches(text: Column) -> Column:
    """Words with a digit or an @."""
    return F.when(text.rlike("[0-9@]"), matches(text, "(?<![^ \\t-\\r])(?=[^ \\t-\\r0-9@]*+[0-9@])[^ \\t-\\r]++"))


def candidates(found: Column, base: Column) -> Column:
    """Of the found words those that touch no base span, without the marks around them."""
    free = F.filter(found, lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (b["end"] > x["start"])))
    lead = lambda v: F.length(v) - F.length(F.regexp_replace(v, "^[^A-Za-z0-9+]+", ""))
    trail = lambda v: F.length(v) - F.length(F.regexp_replace(v, "[^A-Za-z0-9]+$", ""))
    return F.transform(
        free,
        lambda x: F.struct(
            x["kind"],
            (x["start"] + lead(x["value"])).alias("start"),
            (x["end"] - trail(x["value"])).alias("end"),
            F.regexp_replace(x["value"], "^[^A-Za-z0-9+]+|[^A-Za-z0-9]+$", "").alias("value"),
            x["before"],
            x["after"],
        ),
    )


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its id, a digest of its text, base spans and candidates."""
    body, none = F.coalesce(F.col(text), F.lit("")), F.array().cast(OCCURRENCE)
    rows = docs.select(F.col(id).alias("doc_id"), body.alias("_text"))
    found = base_matches(F.col("_text")) | {"word": candidate_matches(F.col("_text"))}
    rows = rows.select("doc_id", F.xxhash64("_text").alias("digest"), *[parts.alias(f"_{kind}") for kind, parts in found.items()])
    spans = {
        kind: F.coalesce(occurrences(F.col(f"_{kind}"), KINDS.index(kind) if kind in KINDS else -1, VALID.get(kind, anything)), none)
        for kind in found
    }
    rows = rows.withColumns({f"_{kind}": column for kind, column in spans.items()})
    rows = rows.withColumn("_base", F.concat(*[f"_{kind}" for kind in KINDS]))
    return rows.select(
        "doc_id",
        "digest",
        *[F.size(f"_{kind}").cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.col("_base").alias("base"),
        candidates(F.col("_word"), F.col("_base")).alias("candidates"),
    )


def fits_kind(value: Column) -> Column:
    """Which kinds a candidate's shape allows, as an array."""
    n = F.length(digits(value))
    rules = (value.contains("@"), (n >= 4) & value.rlike("[.:].*[.:]"), n.between(12, 19), n.between(7, 15) & ~value.rlike("[A-Za-z]"))
    return F.filter(F.array(*[F.when(rule, F.lit(k)) for k, rule in enumerate(rules)]), lambda k: k.isNotNull())


def contexts(x: Column) -> Column:
    """The lexical patterns around an occurrence."""
    tidy = lambda s: F.filter(F.split(F.lower(s), "[ \\t-\\r]+"), lambda w: w != "")
    before, after = tidy(x["before"]), tidy(x["after"])
    one, two, right = F.try_element_at(before, F.lit(-1)), F.try_element_at(before, F.lit(-2)), F.get(after, 0)
    return F.filter(
        F.array(
            F.concat(F.lit("1 "), one, F.lit(" _")),
            F.concat(F.lit("2 "), two, F.lit(" "), one, F.lit(" _")),
            F.concat(F.lit("3 _ "), right),
            F.concat(F.lit("4 "), one, F.lit(" _ "), right),
        ),
        lambda p: p.isNotNull(),
    )


def graph(scanned: DataFrame) -> DataFrame:
    """Distinct edges (pattern, kind, value, seed) between patterns and what they surround; non-identifiers have
    kind ``NONE`` and are no seeds."""
    seeds = scanned.select(F.explode("base").alias("x")).select(
        F.explode(contexts(F.col("x"))).alias("pattern"), F.col("x.kind").alias("kind"), F.lower("x.value").alias("value"), F.lit(True).alias("seed")
    )
    others = scanned.select(F.explode("candidates").alias("x")).select(
        F.explode(contexts(F.col("x"))).alias("pattern"), F.lower("x.value").alias("value"), fits_kind(F.col("x.value")).alias("kinds")
    )
    kinds = F.when(F.size("kinds") > 0, F.col("kinds")).otherwise(F.array(F.lit(NONE)))
    others = others.select("pattern", F.explode(kinds).alias("kind"), "value", F.lit(False).alias("seed"))
    return seeds.union(others).groupBy("pattern", "kind", "value").agg(F.max("seed").alias("seed"))


def pattern_scores(edges: DataFrame, trusted: DataFrame | None) -> DataFrame:
    """Per pattern and kind its support and confidence: (pattern, kind, support, confidence)."""
    rows = edges.withColumn("trust", F.lit(0.0)) if trusted is None else edges.join(trusted, ["value", "kind"], "left")
    known = F.col("seed") | (F.col("kind") == NONE)
    weight = F.when(known, 1.0).otherwise(F.coalesce("trust", F.lit(0.0)))
    per_kind = [F.sum(F.when(F.col("kind") == k, weight).otherwise(0.0)).alias(f"s{k}") for k in range(len(KINDS))]
    sums = rows.groupBy("pattern").agg(F.sum(weight).alias("all"), *per_kind)
    supports = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"s{k}").alias("support")) for k in range(len(KINDS))])
    return sums.select("pattern", "all", F.inline(supports)).select(
        "pattern", "kind", "support", (F.col("support") / (F.col("all") + 1)).alias("confidence")
    )


def value_trust(
    edges: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS,
    min_confidence: float = MIN_CONFIDENCE, min_trust: float = MIN_TRUST,
) -> DataFrame:
    """Trusted candidates (value, kind, trust) after the given rounds."""
    edges = materialise(edges, "pii-edges")
    trusted = None
    for _ in range(rounds):
        patterns = pattern_scores(edges, trusted).filter((F.col("support") >= min_seeds) & (F.col("confidence") >= min_confidence))
        doubt = F.sum(F.log(1 - F.col("confidence")))
        trusted = materialise(
            edges.filter(~F.col("seed"))
            .join(patterns, ["pattern", "kind"])
            .groupBy("value", "kind")
            .agg((1 - F.exp(doubt)).alias("trust"))
            .filter(F.col("trust") >= min_trust),
            "pii-trusted",
        )
    return trusted


def score(edges: DataFrame, **options) -> DataFrame:
    """The trusted values with the kind that is trusted most: (value, kind)."""
    best = F.min(F.struct((-F.col("trust")).alias("t"), "kind"))
    return value_trust(edges, **options).groupBy("value").agg(best.alias("best")).select("value", F.col("best.kind").alias("kind"))


def find_personal_data(docs: DataFrame, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per document: doc_id, counts of base spans, ``base`` and ``found`` (arrays of kind, start, end, value)."""
    scanned = materialise(scan(docs, id, text), "pii-scan")
    values = score(graph(scanned), **options)
    hits = (
        scanned.select("doc_id", "digest", F.explode("candidates").alias("x"))
        .withColumn("value", F.lower("x.value"))
        .join(values, "value")
        .groupBy("doc_id", "digest")
        .agg(F.collect_set(F.struct("kind", "x.start", "x.end", "x.value")).alias("found"))
        .withColumnsRenamed({"doc_id": "_id", "digest": "_digest"})
    )
    plain = "array<struct<kind:int,start:bigint,end:bigint,value:string>>"
    return (
        scanned.join(hits, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left")
        .withColumn("base", F.transform("base", lambda x: F.struct(x["kind"], x["start"], x["end"], x["value"])))
        .withColumn("found", F.coalesce("found", F.array().cast(plain)))
        .drop("candidates", "_id", "_digest", "digest")
    )


def spans_text(spans: Column) -> Column:
    """kind:start:end by kind as listed, then start, joined by commas."""
    names = F.array(*[F.lit(kind) for kind in KINDS])
    ordered = F.sort_array(F.transform(spans, lambda x: F.struct(x["kind"], x["start"], x["end"])))
    text = F.transform(ordered, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string")))
    return F.array_join(text, ",")
