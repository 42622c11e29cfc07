"""Secret scanning: patterns, and a randomness test battery for unlabelled keys.

Patterns find assignments, access keys and long hexadecimal runs. Beside them,
every long run of key characters is a candidate, and so is each long part that the
patterns' spans leave of one: its encoding is inferred from its characters, and three tests ask whether it
could be a uniform random string of that encoding: chi-squared uniformity over
the alphabet, the number of runs above and below the middle of the alphabet, and
the correlation of neighbouring symbols. Fisher's method joins the three.

Written text fails those tests, and the longer it is the more surely. Which
p-values count as failures is decided per encoding and length class, over all
documents, by the Benjamini-Hochberg rule: so at most a share ``fdr`` of the
candidates put aside as text are true random strings, whatever their length.
What is not put aside is reported as random.

Everything is DataFrame functions; a text's spans are worked out within its row,
and the only thing gathered is one threshold per encoding and length class.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from snapmart.llm.common import free_name


@dataclass(frozen=True)
class Pattern:
    """A kind of span: its regular expression, and the group that must have ``least`` characters."""

    kind: str
    regex: str
    group: int
    least: int


#: Fixed patterns, in the order in which spans with the same start are listed.
PATTERNS = (
    Pattern("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Pattern("access", r"AKIA[A-Z0-9]+", 0, 20),
    Pattern("hex", r"[0-9a-f]+", 0, 24),
)
#: Cheap conditions that a text must meet before its pattern's spans are worked out.
_GATES = {"hex": "[0-9a-f]{24}", "access": "AKIA[A-Z0-9]{16}"}

#: Alphabets by encoding, in the order in which they are tried; fixed values.
ALPHABETS = {
    "decimal": "0123456789",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "letters": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "letters64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/-_",
    "hex": "0123456789abcdef",
    "hexupper": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base36lower": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}
#: Lower ends of the length classes of candidates.
LENGTHS = (20, 24, 32, 40, 64, 128)
#: Runs of key characters.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+"
#: p-values are counted in cells of this width, rounded up.
GRID = 1e-4
#: The deviate of a string whose symbols don't vary.
_FAR = 9.0
#: Elements that running sums are worked out for at once, and code points of a piece of a text.
BLOCK, CHUNK = 256, 4096
_SPAN = "struct<start:bigint,stop:bigint,kind:string,body:string>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """``combine`` of the first 1, 2, .. of an array of longs.

    Arrays can't be extended in place, so it is done inside blocks and then over
    the blocks: the work grows with the array, not with its square.
    """
    zero = F.array(F.lit(0).cast("bigint"))

    def along(part: Column) -> Column:
        return F.aggregate(part, zero, lambda acc, v: F.concat(acc, F.array(combine(F.element_at(acc, -1), v))))

    def blocks(whole: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), (F.size(whole) / BLOCK).cast("int")), lambda i: along(F.slice(whole, i * BLOCK + 1, F.lit(BLOCK))))

    def joined(parts: Column) -> Column:
        before = along(F.transform(parts, lambda part: F.element_at(part, -1)))
        moved = F.zip_with(parts, F.slice(before, F.lit(1), F.size(parts)), lambda part, base: F.transform(
            F.slice(part, F.lit(2), F.size(part)), lambda v: combine(base, v)))
        return F.flatten(moved)

    return _let(_let(values, blocks), joined)


def _count_until(spans: Column, holds: Callable[[Column], Column]) -> Column:
    """How many spans from the first ``holds`` is true for, by halving; it must be false for all after the first it is false for."""
    return F.aggregate(
        F.array(*(F.lit(1 << i) for i in range(24, -1, -1))), F.lit(0),
        lambda acc, step: F.when(
            (acc + step <= F.size(spans)) & F.coalesce(holds(F.get(spans, acc + step - 1)), F.lit(False)), acc + step).otherwise(acc))


def _spans(text: Column, pattern: Pattern) -> Column:
    """array<struct<start, stop, kind, body>> of a pattern, leftmost and without overlap.

    Places follow from the lengths of the matches and of what lies between them.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern.regex), F.lit(0))
    body = whole if pattern.group == 0 else F.regexp_extract_all(text, F.lit(pattern.regex), F.lit(pattern.group))
    gaps = F.slice(F.split(text, pattern.regex, -1), F.lit(1), F.size(whole))
    found = F.arrays_zip(whole.alias("whole"), body.alias("body"), gaps.alias("gap"))

    def placed(parts: Column) -> Column:
        sizes = F.transform(parts, lambda part: (F.length(part["gap"]) + F.length(part["whole"])).cast("bigint"))
        with_stop = F.zip_with(parts, _running(sizes, lambda a, b: a + b), lambda part, stop: F.struct(
            (stop - F.length(part["whole"])).alias("start"), stop.alias("stop"), F.lit(pattern.kind).alias("kind"), part["body"].alias("body")))
        return F.filter(with_stop, lambda s: F.length(s["body"]) >= pattern.least)

    none = F.array().cast(f"array<{_SPAN}>")
    return F.when(text.rlike(_GATES.get(pattern.kind, pattern.regex)), _let(found, placed)).otherwise(none)


def _chunks(text: Column) -> Column:
    """A text in pieces of CHUNK code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def _between(chunks: Column, start: Column, stop: Column) -> Column:
    """The code points from ``start`` to ``stop`` of a text in ``chunks``; only the chunks there are read."""
    first, last = F.floor(start / CHUNK).cast("int"), F.floor((stop - 1) / CHUNK).cast("int")
    begin = (start - first * CHUNK + 1).cast("int")
    one = F.substring(F.get(chunks, first), begin, (stop - start).cast("int"))
    more = F.array_join(F.concat(
        F.array(F.substring(F.get(chunks, first), begin, F.lit(CHUNK))), F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))),
        F.array(F.substring(F.get(chunks, last), F.lit(1), (stop - last * CHUNK).cast("int")))), "")
    return F.when(stop <= start, F.lit("")).when(first == last, one).otherwise(more)


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the standard normal; Abramowitz and Stegun 26.2.17, error below 1e-7."""
    def poly(t: Column) -> Column:
        return t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))

    def tail(x: Column) -> Column:
        far = _let(1 / (1 + 0.2316419 * F.abs(x)), poly) * F.exp(-x * x / 2) * 0.3989422804014327
        return F.when(x >= 0, far).otherwise(1 - far)

    return _let(z, tail)


def _encoding(body: Column) -> Column:
    out = F.lit("base64")
    for name, alphabet in reversed(list(ALPHABETS.items())[:-1]):
        out = F.when(F.translate(body, alphabet, "") == "", F.lit(name)).otherwise(out)
    return out


def battery(body: Column) -> Column:
    """struct<encoding, p>: the joint p-value of a string as uniform random in its encoding."""
    table = F.create_map(*[F.lit(x) for pair in ALPHABETS.items() for x in pair])
    out = F.struct(body.alias("body"), _encoding(body).alias("encoding"))
    for level in (
        lambda s: F.struct(
            s["encoding"].alias("encoding"), F.split(s["body"], "").alias("chars"),
            F.length(s["body"]).cast("double").alias("n"), F.element_at(table, s["encoding"]).alias("alphabet")),
        _sums, _deviates, _fisher,
    ):
        out = _let(out, level)
    return out


def _sums(s: Column) -> Column:
    chars, n = s["chars"], s["n"]
    k = F.length(s["alphabet"]).cast("double")
    squares = F.aggregate(
        F.array_distinct(chars), F.lit(0.0),
        lambda acc, c: acc + F.pow(F.size(F.filter(chars, lambda x: x == c)).cast("double"), F.lit(2.0)))
    place = F.transform(chars, lambda c: F.instr(s["alphabet"], c).cast("double"))
    return F.struct(
        s["encoding"].alias("encoding"), n.alias("n"), k.alias("k"), place.alias("place"),
        F.greatest(k / n * squares - n, F.lit(1e-9)).alias("chi"),
        (F.aggregate(place, F.lit(0.0), lambda acc, v: acc + v) / n).alias("avg"),
    )


def _deviates(s: Column) -> Column:
    """Normal deviates: chi-squared (Wilson and Hilferty), runs about the alphabet's middle, lag-one correlation."""
    n, k, place, avg = s["n"], s["k"], s["place"], s["avg"]
    spread = 2.0 / (9.0 * (k - 1))
    pairs = F.arrays_zip(F.slice(place, 1, F.size(place) - 1).alias("a"), F.slice(place, 2, F.size(place)).alias("b"))
    changes = F.size(F.filter(pairs, lambda p: (p["a"] > k / 2) != (p["b"] > k / 2))).cast("double")
    high = F.size(F.filter(place, lambda v: v > k / 2)).cast("double")
    total = F.aggregate(place, F.lit(0.0), lambda acc, v: acc + (v - avg) * (v - avg))
    cross = F.aggregate(pairs, F.lit(0.0), lambda acc, p: acc + (p["a"] - avg) * (p["b"] - avg))

    def runs(r: Column) -> Column:
        var = (r["mean"] - 1) * (r["mean"] - 2) / (n - 1)
        return F.when(var > 0, F.abs(changes + 1 - r["mean"]) / F.sqrt(var)).otherwise(F.lit(_FAR))

    mean = F.struct((2 * high * (n - high) / n + 1).alias("mean"))
    return F.struct(
        s["encoding"].alias("encoding"),
        ((F.pow(s["chi"] / (k - 1), F.lit(1.0 / 3.0)) - (1 - spread)) / F.sqrt(spread)).alias("chi"),
        _let(mean, runs).alias("runs"),
        _let(total, lambda t: F.when(t > 0, F.abs(cross / t + 1 / n) * F.sqrt(n)).otherwise(F.lit(_FAR))).alias("serial"),
    )


def _fisher(s: Column) -> Column:
    """-2 times the sum of the logs of three p-values is chi-squared with 6 degrees of freedom."""
    def log(p: Column) -> Column:
        return F.log(F.greatest(F.least(p, F.lit(1.0)), F.lit(1e-12)))

    half = -(log(_upper_tail(s["chi"])) + log(2 * _upper_tail(s["runs"])) + log(2 * _upper_tail(s["serial"])))
    return _let(half, lambda h: F.struct(s["encoding"].alias("encoding"), (F.exp(-h) * (1 + h + h * h / 2)).alias("p")))


def _length_class(body: Column) -> Column:
    out = F.lit(LENGTHS[0])
    for low in LENGTHS[1:]:
        out = F.when(F.length(body) >= low, F.lit(low)).otherwise(out)
    return out


def _only_signs(body: Column) -> Column:
    """Dates, numbers and rules are no part of the strata of strings with letters."""
    return F.when(~body.rlike("[A-Za-z]") & body.rlike("[+/_-]"), "signs")


def _touched(c: Column, base: Column, kinds: Sequence[Pattern]) -> Column:
    """Whether a span of any kind shares a place with ``c``."""
    def by(spans: Column) -> Column:
        after = F.get(spans, _count_until(spans, lambda s: s["stop"] <= c["start"]))
        return F.coalesce(after["start"] < c["stop"], F.lit(False))

    return reduce(lambda a, b: a | b, (by(base[p.kind]) for p in kinds), F.lit(False))


def _parts(run: Column, base: Column, kinds: Sequence[Pattern]) -> Column:
    """array<struct<start, stop>> of what the base spans leave of a run, if long enough: cut by one kind after the other."""
    def cut(piece: Column, spans: Column) -> Column:
        low = _count_until(spans, lambda s: s["stop"] <= piece["start"])
        high = _count_until(spans, lambda s: s["start"] < piece["stop"])
        inside = F.slice(spans, low + 1, F.greatest(high - low, F.lit(0)))
        return _let(inside, lambda own: F.filter(F.transform(F.sequence(F.lit(0), F.size(own)), lambda i: F.struct(
            F.greatest(piece["start"], F.coalesce(F.get(own, i - 1)["stop"], piece["start"])).alias("start"),
            F.coalesce(F.get(own, i)["start"], piece["stop"]).alias("stop"),
        )), lambda s: s["stop"] - s["start"] >= LENGTHS[0]))

    def cut_all(pieces: Column, spans: Column) -> Column:
        return F.flatten(F.transform(pieces, lambda piece: cut(piece, spans)))

    whole = F.array(F.struct(run["start"].alias("start"), run["stop"].alias("stop")))
    return reduce(cut_all, (base[p.kind] for p in kinds), whole)


def _candidates(text: Column, base: Column, kinds: Sequence[Pattern], only_free: bool = False) -> Column:
    """array<struct<start, stop, kind, stratum, p>> of a text's candidate runs, and of the parts that ``base`` leaves of them.

    ``only_free`` leaves out the runs that a base span touches.
    """
    def tested(c: Column) -> Column:
        return _let(battery(c["body"]), lambda t: F.struct(
            c["start"].alias("start"), c["stop"].alias("stop"), t["encoding"].alias("kind"),
            F.concat_ws("/", t["encoding"], _length_class(c["body"]).cast("string"), _only_signs(c["body"])).alias("stratum"),
            t["p"].alias("p"),
        ))

    def struct(start: Column, stop: Column, body: Column, free: Column) -> Column:
        return F.struct(start.alias("start"), stop.alias("stop"), body.alias("body"), free.alias("free"))

    def with_parts(runs: Column) -> Column:
        joined = F.filter(runs, lambda c: ~c["free"])
        pieces = F.flatten(F.transform(joined, lambda c: _parts(c, base, kinds)))
        parts = _let(_chunks(text), lambda chunks: F.transform(
            pieces, lambda s: struct(s["start"], s["stop"], _between(chunks, s["start"], s["stop"]), F.lit(True))))
        return F.when(F.size(joined) > 0, F.concat(runs, parts)).otherwise(runs)

    runs = F.transform(
        _spans(text, Pattern("candidate", CANDIDATE, 0, LENGTHS[0])),
        lambda c: struct(c["start"], c["stop"], c["body"], ~_touched(c, base, kinds)))
    found = _let(runs, with_parts)
    return F.transform(F.filter(found, lambda c: c["free"]) if only_free else found, tested)


def _base(text: Column, kinds: Sequence[Pattern]) -> Column:
    """struct of each kind's array<struct<start, stop>>, in order of their places."""
    return F.struct(*(
        F.transform(_spans(text, p), lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))).alias(p.kind) for p in kinds))


def thresholds(
    docs: DataFrame, fdr: float, text_col: str = "text", kinds: Sequence[Pattern] = PATTERNS,
) -> dict[str, float]:
    """Largest p-value put aside as text, for each encoding and length class that has one.

    Benjamini-Hochberg over the counts of p-values on a fixed grid: the counts
    are summed by cell before anything is ordered, and there are at most
    1 / GRID cells in each of the few strata. A p-value counts as the upper end
    of its cell, which can only put fewer candidates aside.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    cells = (
        docs.select(text.alias("text")).where(F.col("text").rlike(CANDIDATE))
        .select("text", _base(F.col("text"), kinds).alias("base"))
        .select(F.explode(_candidates(F.col("text"), F.col("base"), kinds)).alias("c"))
        .groupBy(F.col("c.stratum").alias("stratum"), F.ceil(F.col("c.p") / GRID).alias("cell"))
        .agg(F.count("*").alias("n"))
    )
    up = Window.partitionBy("stratum").orderBy("cell")
    ranked = cells.select(
        "stratum", "cell", F.sum("n").over(up).alias("rank"),
        F.sum("n").over(Window.partitionBy("stratum")).alias("total"))
    cut = (
        ranked.where(F.col("cell") * GRID <= fdr * F.col("rank") / F.col("total"))
        .groupBy("stratum").agg(F.max("cell").alias("cell"))
    )
    return {row["stratum"]: row["cell"] * GRID for row in cut.collect()}


def scan(
    docs: DataFrame, fdr: float = 0.05, text_col: str = "text", out_col: str = "secret_spans",
    kinds: Sequence[Pattern] = PATTERNS,
) -> DataFrame:
    """``docs`` with ``out_col``: array<struct<start, stop, kind>>, by start and then kind.

    The work on a text grows with its length and, but for a logarithm, with its spans.
    Places are code points, ``stop`` exclusive. Kinds are those of the patterns,
    and ``random-<encoding>`` for a random string that no pattern's span touches; what
    such spans leave of a longer run is tested by itself. An existing column named ``out_col`` is replaced; all other columns stay. A null or
    empty text has an empty array, an empty table gives an empty one, and
    repeated rows are scanned each. Runs the threshold job at once.
    """
    cut = thresholds(docs, fdr, text_col, kinds)
    text = F.coalesce(F.col(text_col), F.lit(""))
    order = {p.kind: i for i, p in enumerate(kinds)}
    limit = F.create_map(*[F.lit(x) for pair in cut.items() for x in pair]) if cut else None

    def random(base: Column) -> Column:
        def keep(c: Column) -> Column:
            if limit is None:
                return F.lit(True)
            # compared by cell, as it was counted
            return F.ceil(c["p"] / GRID) * GRID > F.coalesce(F.try_element_at(limit, c["stratum"]), F.lit(-1.0))

        return F.transform(F.filter(_candidates(text, base, kinds, only_free=True), keep), lambda c: F.struct(
            c["start"].alias("start"), c["stop"].alias("stop"), F.concat(F.lit("random-"), c["kind"]).alias("kind")))

    def named(base: Column, kind: str) -> Column:
        return F.transform(base[kind], lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), F.lit(kind).alias("kind")))

    rank = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])

    def by_place(a: Column, b: Column) -> Column:
        ra, rb = (F.coalesce(F.try_element_at(rank, x["kind"]), F.lit(len(order))) for x in (a, b))
        return F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(ra - rb)

    at = free_name(docs, "base_spans")
    with_base = docs.withColumn(at, _base(text, kinds))
    spans = F.concat(*(named(F.col(at), p.kind) for p in kinds), random(F.col(at)))
    return with_base.withColumn(out_col, F.array_sort(spans, by_place)).drop(at)


def redact(docs: DataFrame, spans_col: str = "secret_spans", text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span of ``spans_col`` replaced by ``mark``; overlapping spans become one.

    A null text stays null. The column ``spans_col`` is kept.
    """
    text, spans = F.col(text_col), F.col(spans_col)

    def replaced(s: Column) -> Column:
        # a span is fresh unless one before it reaches into it; what stands before it begins where the spans before end
        fresh = F.filter(
            F.zip_with(spans, F.slice(s["ends"], F.lit(1), F.size(spans)), lambda x, end: F.struct(end.alias("end"), x["start"].alias("start"))),
            lambda x: x["start"] >= x["end"])
        parts = F.transform(fresh, lambda x: F.concat(_between(s["chunks"], x["end"], x["start"]), F.lit(mark)))
        return F.array_join(F.concat(parts, F.array(_between(s["chunks"], F.element_at(s["ends"], -1), F.length(text).cast("bigint")))), "")

    ends = F.concat(F.array(F.lit(0).cast("bigint")), _running(F.transform(spans, lambda x: x["stop"]), F.greatest))
    clean = _let(F.struct(_chunks(text).alias("chunks"), ends.alias("ends")), replaced)
    return docs.withColumn(text_col, F.when(F.size(spans_col) > 0, clean).otherwise(text))
