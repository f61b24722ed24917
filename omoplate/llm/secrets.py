"""Secret scan: fixed patterns, and a randomness battery over long tokens.

Only DataFrame functions run here. Positions are code points. Spark returns
matches without their places, so a text is also split at the matches, and
the lengths of pieces and matches before a match add up to its start.

The battery takes every token of 16 or more letters, digits and ``+/_-``
and infers the smallest encoding that holds it (hexadecimal, base 32,
base 36, letters, base 64). It computes the chi-squared statistic of the
characters against a uniform alphabet, the number of runs of one character
class, and the correlation of neighbouring characters. A token must look
random to all three. It must also look unlike text: each test gives the
chance that ordinary writing spread over that alphabet scores as much, and
the three are combined by Fisher's method as Brown corrects it, since runs
and correlation tell much the same. A short token can reach no small
p-value, so tokens are tested in bands of length, and in each band the
Benjamini-Hochberg rule over the distinct tokens of the whole table keeps
the share of false findings at ``FALSE_SHARE``. The rule needs only the
number of p-values in each small interval of their logarithm.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from omoplate.llm.common import cut_lineage, ready, table

ASSIGN = (r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"
          r"|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = r"AKIA[A-Z0-9]{14,}"  # maximal runs of 18 characters or more: what is shorter can be left out at once
HEX = r"[0-9a-f]{16,}"
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}"
KINDS = ("assign", "access", "hex", "random")

#: name, alphabet, its size, chance that neighbours differ in class when random, and how much more
#: often than at random two characters of ordinary text in it are the same (alphabet size times the
#: sum of squared frequencies, less one).
ENCODINGS = (
    ("hex", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 16, 0.469, 0.9),
    ("base32", r"^[A-Z2-7]+$", 32, 0.305, 1.1),
    ("base36", r"^(?:[0-9a-z]+|[0-9A-Z]+)$", 36, 0.401, 1.3),
    ("letters", r"^[A-Za-z]+$", 52, 0.5, 2.4),
    ("base64", r"^[A-Za-z0-9+/_-]+$", 64, 0.645, 3.2),
)
#: Chance that neighbours differ in class in ordinary text.
TEXT_SWITCHES = 0.25
#: Share of the variance of character codes that lies between the classes.
CLASS_SHARE = 0.8
#: Brown's factor for three p-values, two of which correlate by 0.8: the variance of Fisher's sum, 4 * 3 + 2 * 3.08,
#: over twice its mean of 6. The divided sum then has four degrees of freedom.
BROWN = 1.513
#: Standard deviations from random that the battery tolerates.
TOLERANCE = 3.0
#: Lower ends of the length bands.
BANDS = (16, 24, 32, 48, 80)
FALSE_SHARE = 0.001
#: Intervals of -log10 p.
STEP, STEPS = 0.01, 4_000
MASK = "[SECRET]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where the body uses it in a loop."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0), lambda a, x: a + x)


def located(text: Column, pattern: str, group: int = 0) -> Column:
    """``array<start, end, value>`` of the leftmost non-overlapping matches; value is the group."""
    part = 128  # sums of so many lengths are kept, so that a start costs few additions

    def places(s: Column) -> Column:
        n = F.size(s["m"])
        sizes = F.zip_with(F.slice(s["p"], 1, n), s["m"], lambda a, b: F.length(a) + F.length(b))

        def starts(z: Column) -> Column:
            sums = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / part).cast("int")),
                               lambda b: _total(F.slice(z, b * part + 1, F.lit(part))))
            before = let(sums, lambda t: F.transform(F.sequence(F.lit(0), F.size(t) - 1),
                                                     lambda b: _total(F.slice(t, F.lit(1), b))))
            return let(before, lambda t: F.transform(F.sequence(F.lit(0), n - 1), lambda i: let(
                t[F.floor(i / part).cast("int")]
                + _total(F.slice(z, (F.floor(i / part) * part + 1).cast("int"), (i % part).cast("int"))) + F.length(s["p"][i]),
                lambda at: F.struct(at.alias("start"), (at + F.length(s["m"][i])).alias("end"), s["g"][i].alias("value")))))

        return let(sizes, starts)

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return let(found, lambda m: F.when(F.size(m) == 0, none).otherwise(let(F.struct(
        m.alias("m"), F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("g"),
        F.split(text, pattern, -1).alias("p")), places)))


def _spans(found: Column, kind: str) -> Column:
    return F.transform(found, lambda s: F.struct(s["start"], F.lit(KINDS.index(kind)).alias("kind"), s["end"]))


def base_spans(text: Column) -> dict[str, Column]:
    """``array<start, kind, end>`` of the fixed patterns."""
    return {"assign": _spans(F.filter(located(text, ASSIGN, 1), lambda s: F.length(s["value"]) >= 12), "assign"),
            "access": _spans(located(text, ACCESS), "access"), "hex": _spans(located(text, HEX), "hex")}


def upper_tail(value: Column) -> Column:
    """Chance of a standard normal above a value (Abramowitz and Stegun 26.2.17)."""
    def tail(z: Column) -> Column:
        # fixed values of the approximation
        poly = let(1 / (1 + 0.2316419 * F.abs(z)), lambda t: t * (
            0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429)))))
        return let(F.exp(-z * z / 2) / 2.5066282746310002 * poly, lambda p: F.when(z >= 0, p).otherwise(1 - p))

    return let(value, tail)


def _nats(p: Column) -> Column:
    return -F.log(F.greatest(p, F.lit(1e-150)))


def battery(value: Column) -> Column:
    """``struct<n, looks_random, bin>``: bin is -log10 p in steps of ``STEP``, p the chance of text to look so random."""

    encoding = F.lit(len(ENCODINGS))
    for i, e in reversed(list(enumerate(ENCODINGS[:-1], 1))):
        encoding = F.when(value.rlike(e[1]), F.lit(i)).otherwise(encoding)

    def choose(i: int, at: Column) -> Column:
        return F.element_at(F.array(*(F.lit(float(e[i])) for e in ENCODINGS)), at)

    def scored(s: Column) -> Column:
        n, k = s["n"], s["k"]
        chi, expected = k / n * s["squares"] - n, k - 1
        z_chi = (chi - expected) / F.sqrt(2 * expected)
        shift = n * s["excess"]
        p_chi = upper_tail((expected + shift - chi) / F.sqrt(2 * expected + 4 * shift))
        switches = s["runs"] - 1
        z_runs = (switches - (n - 1) * s["switch"]) / F.sqrt((n - 1) * s["switch"] * (1 - s["switch"]))
        p_runs = upper_tail((switches - (n - 1) * TEXT_SWITCHES) / F.sqrt((n - 1) * TEXT_SWITCHES * (1 - TEXT_SWITCHES)))
        z_serial = F.when(s["spread"] > 0, s["neighbours"] / s["spread"] * F.sqrt(n)).otherwise(F.lit(99.0))
        # of classes that change as seldom as in text, their neighbours correlate so much
        p_serial = upper_tail(CLASS_SHARE * (1 - TEXT_SWITCHES / s["switch"]) * F.sqrt(n) - z_serial)
        half = (_nats(p_chi) + _nats(p_runs) + _nats(p_serial)) / BROWN  # Fisher's statistic, halved
        digits = let(half, lambda h: (h - F.log(1 + h)) / 2.302585092994046)
        looks = (z_chi <= TOLERANCE) & (F.abs(z_runs) <= TOLERANCE) & (F.abs(z_serial) <= TOLERANCE)
        return F.struct(n.cast("int").alias("n"), looks.alias("looks_random"),
                        F.least(F.floor(F.greatest(digits, F.lit(0.0)) / STEP), F.lit(STEPS)).cast("int").alias("bin"))

    def counted(c: Column, at: Column) -> Column:
        def around(mean: Column) -> Column:
            n = F.size(c)
            away = F.transform(c, lambda x: F.ascii(x) - mean)
            zero = F.lit(0.0)
            return let(away, lambda a: F.struct(
                n.cast("double").alias("n"), choose(2, at).alias("k"), choose(3, at).alias("switch"),
                choose(4, at).alias("excess"),
                F.aggregate(F.array_distinct(c), zero, lambda t, x: t + F.pow(
                    n - F.length(F.replace(value, x, F.lit(""))), F.lit(2.0))).alias("squares"),
                F.size(F.regexp_extract_all(value, F.lit("[0-9]+|[a-z]+|[A-Z]+|[+/_-]+"), F.lit(0))).alias("runs"),
                F.aggregate(F.transform(a, lambda x: x * x), zero, lambda t, x: t + x).alias("spread"),
                F.aggregate(F.zip_with(F.slice(a, F.lit(1), n - 1), F.slice(a, F.lit(2), n - 1), lambda x, y: x * y), zero,
                            lambda t, x: t + x).alias("neighbours")))

        return let(F.aggregate(c, F.lit(0.0), lambda t, x: t + F.ascii(x)) / F.size(c), around)

    # split at the empty pattern gives the characters
    chars = F.filter(F.split(value, ""), lambda x: x != "")
    return let(let(encoding, lambda at: let(chars, lambda c: counted(c, at))), scored)


def band_of(n: Column) -> Column:
    out = F.lit(0)
    for i, low in enumerate(BANDS):
        out = F.when(n >= low, F.lit(i)).otherwise(out)
    return out


def tested(text: Column) -> Column:
    """``array<start, end, key, band, looks_random, bin>`` of all tokens; key tells tokens apart."""
    return F.transform(located(text, TOKEN), lambda s: let(battery(s["value"]), lambda b: F.struct(
        s["start"], s["end"], F.xxhash64(s["value"]).alias("key"), band_of(b["n"]).alias("band"), b["looks_random"], b["bin"])))


def thresholds(rows: DataFrame, tests: str) -> dict[int, int]:
    """By band, the lowest bin that Benjamini-Hochberg accepts, with a token of many copies as one test.
    At most a few bands times ``STEPS`` counts."""
    once = rows.select(F.explode(tests).alias("t")).select("t.key", "t.band", "t.bin").distinct()
    bins = once.groupBy("band", "bin").agg(F.count(F.lit(1)).alias("n"))
    above = Window.partitionBy("band").orderBy(F.desc("bin"))
    ranked = bins.withColumns({"reached": F.sum("n").over(above), "tests": F.sum("n").over(Window.partitionBy("band"))})
    fine = ranked.filter(F.pow(F.lit(10.0), -F.col("bin") * STEP) <= FALSE_SHARE * F.col("reached") / F.col("tests"))
    return {r["band"]: r["low"] for r in fine.groupBy("band").agg(F.min("bin").alias("low")).collect()}


def overlaps(spans: Column, t: Column) -> Column:
    """Whether one of ``spans``, in order and apart from each other, overlaps ``t``: the last that starts before
    the end of ``t`` is found by halving."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(spans) + F.lit(1.0))).cast("int"))
    whole = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))

    def halved(a: Column) -> Column:
        return let(F.floor((a["low"] + a["high"]) / 2).cast("int"), lambda mid: F.when(a["low"] >= a["high"], a).when(
            F.get(spans, mid)["start"] < t["end"], F.struct((mid + 1).alias("low"), a["high"].alias("high"))).otherwise(
            F.struct(a["low"].alias("low"), mid.alias("high"))))

    return F.coalesce(let(F.aggregate(steps, whole, lambda a, _: halved(a), lambda a: a["low"]),
                          lambda n: (n > 0) & (F.get(spans, n - 1)["end"] > t["start"])), F.lit(False))


def random_spans(tests: Column, found: list[Column], low: dict[int, int]) -> Column:
    """Accepted candidates that overlap no span of the ``found`` kinds."""
    def accepted(t: Column) -> Column:
        ok = F.lit(False)
        for band, b in low.items():
            ok = ok | ((t["band"] == band) & (t["bin"] >= b))
        return ok & t["looks_random"]

    def alone(t: Column) -> Column:
        return ~reduce(or_, (overlaps(spans, t) for spans in found))

    free = F.filter(F.filter(tests, accepted), alone)
    return F.transform(free, lambda t: F.struct(t["start"], F.lit(KINDS.index("random")).alias("kind"), t["end"]))


def _written(spans: Column) -> Column:
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"], s["end"])), ",")


def _random(low: dict[int, int]) -> Column:
    return random_spans(F.col("_tests"), [F.col(f"_{k}") for k in KINDS[:3]], low)


def _found(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with the base spans by kind and the tested candidates."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn("_text", text).withColumns(
        {**{f"_{k}": c for k, c in base_spans(F.col("_text")).items()}, "_tests": tested(F.col("_text"))})


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans``.

    A null or empty text has no spans; one of many spans costs as much a
    token as any other. Rows repeat as they come, a null doc_id stays null,
    and copies of a token are one test and all found or none. An empty
    table gives no rows; other columns are ignored.
    """
    ready(docs.sparkSession)
    rows = cut_lineage(_found(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).drop("text", "_text"))
    low = thresholds(rows, "_tests")
    rows = rows.withColumn("_base", F.array_sort(F.concat("_assign", "_access", "_hex")))
    rows = rows.withColumn("_random", _random(low))
    return rows.select(
        "doc_id", *(F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS),
        F.sha2(_written(F.col("_base")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat("_base", "_random"))).alias("spans"))


def mask_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with every span, overlapping ones as one, replaced by ``MASK`` and n_chars following the
    text, if there is such a column. Texts without a span, null ones too, stay as they are."""
    ready(docs.sparkSession)
    # the columns travel in a struct, so that none can clash with those added here
    rows = cut_lineage(_found(docs.select(F.struct("*").alias("row"), "text")).drop("text", "_text"))
    low = thresholds(rows, "_tests")
    rows = rows.withColumn("_text", F.coalesce(F.col("row.text").cast("string"), F.lit("")))
    rows = rows.withColumn("_base", F.array_sort(F.concat("_assign", "_access", "_hex")))
    rows = rows.withColumn("_all", F.array_sort(F.concat("_base", _random(low))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def replaced(a: Column, s: Column) -> Column:
        fresh = F.when(s["start"] >= a["at"], F.concat(
            F.substring(F.col("_text"), a["at"] + 1, s["start"] - a["at"]), F.lit(MASK))).otherwise(F.lit(""))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), F.concat(a["out"], fresh).alias("out"))

    clean = F.aggregate("_all", start, replaced, lambda a: F.concat(
        a["out"], F.substring(F.col("_text"), a["at"] + 1, F.length(F.col("_text")))))
    rows = rows.withColumn("_masked", F.when(F.size("_all") > 0, clean))
    new = {"text": F.coalesce("_masked", "row.text")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("_masked").isNotNull(), F.length("_masked")).otherwise(F.col("row.n_chars")).cast(kind)
    return rows.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))


ORACLE_SQL = {}
