"""Secrets in texts: three fixed patterns, and strings that pass a battery of randomness tests.

Every candidate (16 or more characters of a base-64 alphabet) gets the smallest usual encoding that it
fits; what holds ``/``, ``-``, ``_`` or ``+`` is tested whole, between slashes, and by its letters and
digits alone, and the longest that passes counts. Against the hypothesis that its characters are drawn at
random from that alphabet stand three tests: chi-squared for uniform use of the alphabet, the number
of runs in its upper and lower half, and serial correlation. Fisher's method makes one probability
of the three. It is uniform for keys and near zero for names, paths and words. At 16 letters the three
cannot tell a word from a key, so strings without a digit must also not look like words: the
likelihood of their letters in European languages, against an even alphabet, is a fourth test, and the
smaller of both probabilities counts (as the smaller of two).

Which strings count as random is decided for each encoding and length class (octave) of the whole
corpus: strings above one half estimate how many are random, and the lowest threshold is taken
at which no more than ``FALSE_SHARE`` of what passes is expected not to be. Short strings,
where the tests tell little apart, thus face a higher bar than long ones.

Only DataFrame expressions run: a regular expression finds matches, splitting by the same
expression finds the gaps between them, and running sums of both are the places.

Defined results: a null text is empty. Matches of one kind do not overlap; of the added spans
(kind ``random``), those that overlap a match of a pattern are left out. Places count code points.
Long texts with many matches cost in proportion: spans are compared in one order.
Repeated rows are scanned alike; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from emberlink.llm.common import cut_lineage, fresh, table

# The patterns, in the order that kinds are listed.
PATTERNS = {
    "assign": r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"(?<![0-9a-f])[0-9a-f]{24,}",
}
ASSIGNED = 6  # least characters of an assigned value
KINDS = [*PATTERNS, "random"]

CANDIDATES = [r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+", r"(?<![A-Za-z0-9+_-])[A-Za-z0-9+_-]{16,}+", r"(?<![A-Za-z0-9])[A-Za-z0-9]{16,}+"]
# Encodings by the strings they fit, smallest alphabet first; of base 64 there are two alphabets.
DIGITS, UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = {
    "digits": (r"^[0-9]+$", DIGITS),
    "hex": (r"^[0-9a-f]+$", "0123456789abcdef"),
    "HEX": (r"^[0-9A-F]+$", "0123456789ABCDEF"),
    "lower26": (r"^[a-z]+$", UPPER.lower()),
    "upper26": (r"^[A-Z]+$", UPPER),
    "base32": (r"^[A-Z2-7]+$", UPPER + "234567"),
    "lower36": (r"^[a-z0-9]+$", DIGITS + UPPER.lower()),
    "upper36": (r"^[A-Z0-9]+$", DIGITS + UPPER),
    "letters52": (r"^[A-Za-z]+$", UPPER + UPPER.lower()),
    "base62": (r"^[A-Za-z0-9]+$", DIGITS + UPPER + UPPER.lower()),
    "letters54": (r"^[A-Za-z+/]+$", UPPER + UPPER.lower() + "+/"),
    "letters54url": (r"^[A-Za-z_-]+$", UPPER + UPPER.lower() + "-_"),
    "base64": (r"^[A-Za-z0-9+/]+$", UPPER + UPPER.lower() + DIGITS + "+/"),
    "base64url": (r"^[A-Za-z0-9_-]+$", UPPER + UPPER.lower() + DIGITS + "-_"),
}
LETTERS = ["lower26", "upper26", "letters52", "letters54", "letters54url"]  # of these the letters come first
# Letters in a thousand, the mean of English, German, French and Spanish; scores are logarithms against an even alphabet.
_FREQUENT = dict(zip(UPPER, (85, 16, 32, 45, 140, 14, 19, 30, 68, 4, 6, 45, 28, 76, 61, 19, 6, 66, 74, 68, 40, 12, 11, 2, 8, 5)))
SCORES = [math.log(26 * x / sum(_FREQUENT.values())) for x in _FREQUENT.values()]
FALSE_SHARE = 0.05
BINS = 100  # of probabilities, when thresholds are set
_CHUNK = 512
MASK = "[SECRET]"


# ---- places of matches --------------------------------------------------------------------


def _walk(steps: Column, start: Column) -> Column:
    """Places of ``steps`` (gap, size, token) from ``start`` on."""
    place = lambda acc, x: F.struct((acc["at"] + x["gap"]).alias("start"), (acc["at"] + x["gap"] + x["size"]).alias("stop"), x["token"].alias("token"))
    empty = F.array().cast("array<struct<start:long,stop:long,token:string>>")
    return F.aggregate(
        steps,
        F.struct(start.cast("long").alias("at"), empty.alias("out")),
        lambda acc, x: F.struct((acc["at"] + x["gap"] + x["size"]).alias("at"), F.concat(acc["out"], F.array(place(acc, x))).alias("out")),
        lambda acc: acc["out"],
    )


def places(text: Column, pattern: str, matches: Column) -> Column:
    """``array<struct<start,stop,token>>`` for ``matches``, all matches of ``pattern`` in ``text``.

    Running sums go by chunks, so that many matches in one text do not cost their square.
    """
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(matches))
    steps = F.zip_with(gaps, matches, lambda gap, token: F.struct(F.length(gap).cast("long").alias("gap"), F.length(token).cast("long").alias("size"), token.alias("token")))
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / _CHUNK).cast("int")), lambda c: F.slice(steps, c * _CHUNK + 1, F.lit(_CHUNK)))
    add = lambda total, x: total + x["gap"] + x["size"]
    sums = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0).cast("long"), add))
    starts = F.aggregate(sums, F.array(F.lit(0).cast("long")), lambda acc, s: F.concat(acc, F.array(F.element_at(acc, -1) + s)))
    found = F.flatten(F.zip_with(chunks, F.slice(starts, F.lit(1), F.size(chunks)), lambda c, at: _walk(c, at)))
    return F.when(F.size(matches) > 0, found).otherwise(F.array().cast("array<struct<start:long,stop:long,token:string>>"))


# ---- the battery ----------------------------------------------------------------------------


def _inverse(z: Column) -> Column:
    return 1 / (1 + 0.3275911 * F.abs(z) / F.sqrt(F.lit(2.0)))


def upper_tail(z: Column, t: Column | None = None) -> Column:
    """The probability that a standard normal variable exceeds ``z`` (Abramowitz and Stegun 7.1.26).

    ``t`` is a column of ``_inverse(z)``, where ``z`` is not small enough an expression to be repeated.
    """
    t = _inverse(z) if t is None else t
    series = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    half = 0.5 * series * F.exp(-z * z / 2)
    return F.when(z >= 0, half).otherwise(1 - half)


def _measures(token: Column, alphabet: Column, letters: Column) -> Column:
    """One pass over the characters' values, and one over the same values in order of size."""
    values = F.transform(F.split(token, ""), lambda c: F.call_function("instr", alphabet, c) - 1)
    values = F.filter(values, lambda v: v >= 0)
    half = F.length(alphabet) / 2
    start = F.struct(
        F.lit(-1.0).alias("last"), F.lit(-1.0).alias("first"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("squares"),
        F.lit(0.0).alias("products"), F.lit(0.0).alias("high"), F.lit(0.0).alias("runs"),
    )

    def step(a: Column, v: Column) -> Column:
        v = v.cast("double")
        begun = a["last"] >= 0
        turned = ~begun | ((a["last"] >= half) != (v >= half))
        return F.struct(
            v.alias("last"), F.when(begun, a["first"]).otherwise(v).alias("first"), (a["sum"] + v).alias("sum"), (a["squares"] + v * v).alias("squares"),
            (a["products"] + F.when(begun, a["last"] * v).otherwise(0.0)).alias("products"), (a["high"] + (v >= half).cast("double")).alias("high"),
            (a["runs"] + turned.cast("double")).alias("runs"),
        )

    equal = F.aggregate(
        F.array_sort(values),
        F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("same"), F.lit(0.0).alias("squared")),
        lambda a, v: F.when(a["last"] == v, F.struct(v.alias("last"), (a["same"] + 1).alias("same"), (a["squared"] + 2 * a["same"] + 1).alias("squared")))
        .otherwise(F.struct(v.alias("last"), F.lit(1.0).alias("same"), (a["squared"] + 1).alias("squared"))),
        lambda a: a["squared"],
    )
    score = lambda v: F.when(v < 52, F.element_at(F.array(*map(F.lit, SCORES)), (v % 26 + 1).cast("int"))).otherwise(0.0)
    words = F.when(letters, F.aggregate(values, F.lit(0.0), lambda a, v: a + score(v)))
    return F.struct(F.aggregate(values, start, step).alias("walk"), words.alias("words"), equal.alias("squared"), F.size(values).cast("double").alias("n"), F.length(alphabet).cast("double").alias("k"))


def _with_probability(measured: DataFrame) -> DataFrame:
    """Add ``p``, Fisher's combination of the three tests, from the measures ``m`` of a token; for letters, with the fourth.

    Column by column: one expression would hold each of its parts hundreds of times.
    """
    c = F.col
    df = measured.select("*", "m.n", "m.k", "m.squared", "m.words", "m.walk.*")
    low, mean, share = c("n") - c("high"), c("sum") / c("n"), F.least(F.lit(1.0), 52 / c("k"))
    df = df.withColumns({"low": low, "mean": mean, "share": share})
    df = df.withColumns(
        {
            "expected": 2 * c("high") * c("low") / c("n") + 1,
            "around": c("squares") - c("n") * c("mean") * c("mean"),
            "lagged": c("products") - c("mean") * (2 * c("sum") - c("first") - c("last")) + (c("n") - 1) * c("mean") * c("mean"),
            "of_letters": c("share") * (sum(SCORES) / 26),
            "of_squares": c("share") * (sum(x * x for x in SCORES) / 26),
        }
    )
    varies = (c("high") > 0) & (c("low") > 0) & (c("expected") > 2)
    z = {
        "uniform": (c("k") / c("n") * c("squared") - c("n") - (c("k") - 1)) / F.sqrt(2 * (c("k") - 1) * (c("n") - 1) / c("n")),
        "by_runs": F.when(varies, F.abs(c("runs") - c("expected")) / F.sqrt((c("expected") - 1) * (c("expected") - 2) / (c("n") - 1))),
        "by_lag": F.when(c("around") > 0, F.abs(c("lagged") / c("around") + 1 / c("n")) * F.sqrt("n")),
        "by_words": (c("words") - c("n") * c("of_letters")) / F.sqrt(c("n") * (c("of_squares") - c("of_letters") * c("of_letters"))),
    }
    df = df.withColumns({f"z_{k}": v for k, v in z.items()}).withColumns({f"t_{k}": _inverse(c(f"z_{k}")) for k in z})
    sides = {"uniform": 1, "by_runs": 2, "by_lag": 2, "by_words": 1}
    df = df.withColumns({f"p_{k}": sides[k] * upper_tail(c(f"z_{k}"), c(f"t_{k}")) for k in z})
    three = [F.log(F.greatest(F.coalesce(f"p_{k}", F.lit(0.0)), F.lit(1e-9))) for k in ("uniform", "by_runs", "by_lag")]
    df = df.withColumn("t", -sum(three, F.lit(0.0))).withColumn("fisher", F.least(F.lit(1.0), F.exp(-c("t")) * (1 + c("t") + c("t") * c("t") / 2)))
    df = df.withColumn("least", F.least("fisher", "p_by_words"))
    return df.withColumn("p", F.when(c("words").isNull(), c("fisher")).otherwise(1 - (1 - c("least")) * (1 - c("least"))))


def _encoding(token: Column) -> Column:
    found = F.lit(None).cast("string")
    for name, (pattern, _) in reversed(ENCODINGS.items()):
        found = F.when(token.rlike(pattern), F.lit(name)).otherwise(found)
    return found


def _alphabet(encoding: Column) -> Column:
    found = F.lit("")
    for name, (_, letters) in ENCODINGS.items():
        found = F.when(encoding == name, F.lit(letters)).otherwise(found)
    return found


# ---- the scan -------------------------------------------------------------------------------


def _with_places(df: DataFrame, text: str, patterns: dict[str, str]) -> DataFrame:
    """Add ``_at_`` columns: places of all matches of each pattern in the column ``text``."""
    matched = df.withColumns({f"_all_{k}": F.expr(f"regexp_extract_all({text}, {_quoted(p)}, 0)") for k, p in patterns.items()})
    return matched.withColumns({f"_at_{k}": places(F.col(text), p, F.col(f"_all_{k}")) for k, p in patterns.items()})


def _parts(tokens: DataFrame, pattern: str) -> DataFrame:
    """What ``pattern`` finds within tokens (``_row``, ``start``, ``stop``, ``token``), as tokens."""
    inner = _with_places(tokens.withColumnRenamed("start", "_from"), "token", {"part": pattern})
    found = inner.select("_row", "_from", F.explode("_at_part").alias("m"))
    return found.select("_row", (F.col("_from") + F.col("m.start")).alias("start"), (F.col("_from") + F.col("m.stop")).alias("stop"), "m.token")


def _shape(found: Column, kind: int) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["stop"].alias("stop")))


def _found(docs: DataFrame, keys: list[str], text_col: str) -> DataFrame:
    """``keys`` and ``_row``, a number of each row, with ``base`` (start, kind number, stop) and ``tokens``, the longest candidates."""
    df = docs.select(*keys, F.monotonically_increasing_id().alias("_row"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    df = _with_places(df, "_text", {**PATTERNS, "tokens": CANDIDATES[0]})
    assigned = F.filter("_at_assign", lambda m: F.length(F.regexp_extract(m["token"], PATTERNS["assign"], 2)) >= ASSIGNED)
    kinds = [assigned, F.col("_at_access"), F.col("_at_hex")]
    shaped = [_shape(found, number) for number, found in enumerate(kinds)]
    return df.select(*keys, "_row", F.array_sort(F.concat(*shaped)).alias("base"), F.col("_at_tokens").alias("tokens"))


def _judged(found: DataFrame) -> DataFrame:
    """(``_row``, ``start``, ``stop``, ``stratum``, ``p``) of every candidate: a token, or a part of one between signs."""
    tokens = found.select("_row", F.inline("tokens"))
    # Parts lie within the longest candidates. Each list is of strings that the others do not hold.
    slashed = F.col("token").contains("/")
    between = _parts(tokens.where(slashed), CANDIDATES[1])
    plain = _parts(tokens.where(~slashed).unionByName(between).where(F.col("token").rlike("[+_-]")), CANDIDATES[2])
    # Written, as the steps that follow would be planned once for each list, and the measures once for each of their uses.
    every = cut_lineage(tokens.unionByName(between).unionByName(plain), "secrets-tokens")
    coded = every.withColumn("encoding", _encoding(F.col("token"))).where("encoding is not null")
    letters = F.col("encoding").isin(LETTERS)
    measured = coded.select("_row", "start", "stop", "encoding", _measures(F.col("token"), _alphabet(F.col("encoding")), letters).alias("m"))
    measured = cut_lineage(measured, "secrets-measures")
    octave = F.floor(F.log2((F.col("stop") - F.col("start")).cast("double"))).cast("string")
    return _with_probability(measured).select("_row", "start", "stop", F.concat("encoding", F.lit(":"), octave).alias("stratum"), "p")


def _quoted(pattern: str) -> str:
    """A pattern as a SQL literal."""
    return "r'" + pattern + "'" if "'" not in pattern else "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def thresholds(judged: DataFrame, false_share: float = FALSE_SHARE) -> dict[str, float]:
    """The least probability that counts as random, for each stratum; there are at most some dozens."""
    bins = judged.select("stratum", F.least(F.floor(F.col("p") * BINS), F.lit(BINS - 1)).cast("int").alias("bin"))
    found: dict[str, list[int]] = {}
    for row in bins.groupBy("stratum", "bin").count().collect():
        found.setdefault(row["stratum"], [0] * BINS)[row["bin"]] = row["count"]
    least = {}
    for stratum, counts in found.items():
        random_per_bin = sum(counts[BINS // 2 :]) / (BINS - BINS // 2)
        least[stratum] = 0.5
        for b in range(BINS // 2):
            passed = sum(counts[b:])
            if passed and 1 - min(1.0, random_per_bin * (BINS - b) / passed) <= false_share:
                least[stratum] = b / BINS
                break
    return least


def _apart(passed: DataFrame, base: DataFrame) -> DataFrame:
    """Candidates (``_row``, ``start``, ``stop``) that no longer one holds and no match of a pattern overlaps.

    In order of start, the furthest stop so far tells both, and the next start of a match the rest: one sort
    of each text's spans, however many there are.
    """
    rows = passed.select("_row", "start", "stop", "wide", F.lit(False).alias("fixed"))
    rows = rows.unionByName(base.select("_row", "start", "stop", F.lit(False).alias("wide"), F.lit(True).alias("fixed")))
    order = Window.partitionBy("_row").orderBy("start", F.desc("fixed"), F.desc("stop"))
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(1, Window.unboundedFollowing)
    seen = rows.withColumns(
        {
            "held": F.max(F.when(F.col("wide"), F.col("stop"))).over(before),
            "reached": F.max(F.when(F.col("fixed"), F.col("stop"))).over(before),
            "next": F.min(F.when(F.col("fixed"), F.col("start"))).over(after),
        }
    )
    free = F.expr("not fixed and coalesce(held < stop, true) and coalesce(reached <= start, true) and coalesce(next >= stop, true)")
    return seen.where(free).select("_row", "start", "stop")


def scan(docs: DataFrame, keys: list[str], text_col: str = "text", false_share: float = FALSE_SHARE) -> DataFrame:
    """``keys``, ``base`` and all ``spans`` (start, kind number in ``KINDS``, stop) of each row, in order."""
    found = cut_lineage(_found(docs, keys, text_col), "secrets-found")
    judged = cut_lineage(_judged(found), "secrets-judged")
    limits = thresholds(judged, false_share)
    spans = F.col("base")
    if limits:
        limit = F.element_at(F.create_map(*[F.lit(x) for pair in sorted(limits.items()) for x in pair]), F.col("stratum"))
        # Only what goes by an encoding with more than letters and digits can hold another.
        passed = judged.where(F.col("p") >= limit).withColumn("wide", F.col("stratum").rlike("^(letters54|base64)"))
        base = found.where(F.size("base") > 0).select("_row", F.inline("base"))
        random = F.struct("start", F.lit(KINDS.index("random")).alias("kind"), "stop")
        added = _apart(passed, base).groupBy("_row").agg(F.collect_list(random).alias("added"))
        found = found.join(cut_lineage(added, "secrets-added"), "_row", "left")
        spans = F.when(F.col("added").isNull(), spans).otherwise(F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(found.schema["base"].dataType)))))
    return found.select(*keys, "base", spans.alias("spans"))


def _listed(spans: str) -> Column:
    """Spans as text: kind:start:stop, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redact(docs: DataFrame) -> DataFrame:
    """All documents, with a mask in the place of every secret, and ``n_chars`` to match."""
    row, spans, merged = (fresh(docs.columns, c) for c in ("row_key", "spans", "merged"))
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    found = scan(keyed.where("text is not null").select(row, "text"), [row]).where(F.size("spans") > 0).groupBy(row).agg(F.first("spans").alias(spans))
    join = lambda acc, s: F.when(
        (F.size(acc) > 0) & (s["start"] < F.element_at(acc, -1)["stop"]),
        F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(s["stop"], F.element_at(acc, -1)["stop"]).alias("stop")))),
    ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["stop"].alias("stop")))))
    df = keyed.join(found, row, "left").withColumn(merged, F.aggregate(spans, F.array().cast("array<struct<start:long,stop:long>>"), join))
    before = F.concat(F.array(F.lit(0).cast("long")), F.transform(merged, lambda s: s["stop"]))
    after = F.concat(F.transform(merged, lambda s: s["start"]), F.array(F.length("text").cast("long")))
    parts = F.zip_with(before, after, lambda a, b: F.substring(F.col("text"), (a + 1).cast("int"), (b - a).cast("int")))
    masked = F.when(F.col(spans).isNotNull(), F.array_join(parts, MASK)).otherwise(F.col("text"))
    df = df.withColumn("text", masked)
    n_chars = F.when(F.col(spans).isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return df.withColumn("n_chars", n_chars).select(*docs.columns)


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text of ``documents``: pattern matches, their digest, and all spans."""
    found = scan(table(spark, sf_dir, "documents"), ["doc_id"])
    count = lambda kind: F.size(F.filter("base", lambda b: b["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in PATTERNS], F.sha2(_listed("base").cast("binary"), 256).alias("base_sha256"), _listed("spans").alias("spans"))
