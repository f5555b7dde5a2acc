"""Secret scan: fixed patterns, and long tokens that a battery of tests finds random."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .native import let, sums_before
from .registry import query

# The base patterns. A run of these symbols is matched whole, so the least length can
# stand in the pattern, but for assign: there a short match uses up its text and is dropped after.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_CHARS = 8
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}"
MIN_CHARS = 20
BATTERY_LEVEL = 0.001
FALSE_RATE = 0.05
_BINS = 100

_DIGITS, _UPPER, _LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Encodings in the order of inference: pattern, symbols in order of their values, and the
# chance that two symbols of ordinary text written in them agree.
ENCODINGS = (
    ("[0-9]+", _DIGITS, 0.14),
    ("[0-9a-f]+", _DIGITS + _LOWER[:6], 0.10),
    ("[0-9A-F]+", _DIGITS + _UPPER[:6], 0.10),
    ("[a-z]+", _LOWER, 0.066),
    ("[A-Z]+", _UPPER, 0.066),
    ("[A-Z2-7]+", _UPPER + "234567", 0.06),
    ("[A-Za-z]+", _UPPER + _LOWER, 0.06),
    ("[A-Za-z0-9]+", _UPPER + _LOWER + _DIGITS, 0.055),
    ("[A-Za-z0-9+/]+", _UPPER + _LOWER + _DIGITS + "+/", 0.055),
    ("[A-Za-z0-9_-]+", _UPPER + _LOWER + _DIGITS + "-_", 0.055),
    ("[A-Za-z0-9+/_-]+", _UPPER + _LOWER + _DIGITS + "+/-_", 0.055),
)


def normal_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal variable, by a rational form of erfc (relative error about 1e-7)."""

    def half(x: Column, t: Column) -> Column:
        # Published coefficients, highest power first.
        series = F.lit(0.17087277)
        for c in (-0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223):
            series = series * t + c
        return t * F.exp(series - x * x) / 2

    upper = let(F.abs(z) / F.sqrt(F.lit(2.0)), lambda x: let(1 / (1 + x / 2), lambda t: half(x, t)))
    return let(upper, lambda u: F.when(z >= 0, u).otherwise(1 - u))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """(start, end, body) of the leftmost non-overlapping matches; code points, end exclusive; body is the group.

    The text between matches and the matches, laid end to end, give the places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    bodies = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))

    def placed(f: Column, g: Column, own: Column) -> Column:
        steps = F.transform(f, lambda x, i: own[i] + F.length(x))
        return let(
            sums_before(steps),
            lambda before: F.transform(
                f,
                lambda x, i: F.struct(
                    (before[i] + own[i]).alias("start"), (before[i] + own[i] + F.length(x)).alias("end"), g[i].alias("body")
                ),
            ),
        )

    return let(found, lambda f: let(bodies, lambda g: let(between, lambda own: placed(f, g, own))))


_SPANS = "array<struct<start:bigint,kind:int,end:bigint>>"


def _spans(text: Column, likely: Column, pattern: str, group: int, least: int, kind: str) -> Column:
    """Spans of one base kind; texts that are not ``likely`` to have one are not searched further."""
    found = F.filter(matches(text, pattern, group), lambda m: F.length(m["body"]) >= least)
    made = F.transform(found, lambda m: F.struct(m["start"], F.lit(KINDS.index(kind)).alias("kind"), m["end"]))
    return F.when(likely, made).otherwise(F.array()).cast(_SPANS)


def _alphabet(body: Column) -> tuple[Column, Column]:
    """(symbols, agreement) of the encoding inferred for a token."""
    symbols, agree = F.lit(None).cast("string"), F.lit(None).cast("double")
    for pattern, own, chance in reversed(ENCODINGS):
        fits = body.rlike(f"^{pattern}$")
        symbols, agree = F.when(fits, F.lit(own)).otherwise(symbols), F.when(fits, F.lit(chance)).otherwise(agree)
    return symbols, agree


def battery(body: Column) -> Column:
    """(p_random, p_plain) of a token of at least a few characters.

    ``p_random``: the least p-value of chi-squared uniformity, runs above and below the middle
    of the alphabet, and lag-one serial correlation, corrected for there being three: small
    if the token is not a uniform draw from its alphabet. ``p_plain``: the chance that
    ordinary text of this length in this alphabet is as even as the token (its chi-squared
    is non-central; the shift grows with the length).
    """

    def tests(symbols: Column, agree: Column) -> Column:
        n = F.length(body).cast("double")
        kinds = F.length(symbols).cast("double")
        squares = F.aggregate(
            F.split(symbols, ""),
            F.lit(0.0),
            lambda a, s: a + F.pow((F.length(body) - F.length(F.replace(body, s, F.lit("")))).cast("double"), F.lit(2.0)),
        )
        middle = (kinds + 1) / 2

        def scores(sums: Column, chi: Column, first: Column, last: Column) -> Column:
            """z of the three tests from sums over the token's symbols."""
            free = kinds - 1
            z_chi = (F.pow(chi / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
            high, low = sums["high"], n - sums["high"]
            mean = 2 * high * low / n + 1
            spread = (mean - 1) * (mean - 2) / (n - 1)
            z_runs = F.when(spread > 0, (sums["changes"] + 1 - mean) / F.sqrt(spread)).otherwise(F.lit(-40.0))
            centre = sums["values"] / n
            power = sums["squares"] - n * centre * centre
            # The products of centred neighbours, multiplied out.
            lagged = sums["products"] - centre * (2 * sums["values"] - first - last) + (n - 1) * centre * centre
            z_serial = F.when(sums["mixed"], (lagged / power + 1 / n) * F.sqrt(n)).otherwise(F.lit(40.0))
            shift = (n - 1) * (kinds * agree - 1)
            z_plain = (chi - free - shift) / F.sqrt(2 * (free + 2 * shift))
            return F.struct(z_chi.alias("chi"), F.abs(z_runs).alias("runs"), F.abs(z_serial).alias("serial"), (-z_plain).alias("plain"))

        def judged(z: Column) -> Column:
            least = F.least(normal_tail(z["chi"]), 2 * normal_tail(z["runs"]), 2 * normal_tail(z["serial"]), F.lit(1.0))
            return F.struct((1 - F.pow(1 - least, F.lit(3.0))).alias("p_random"), normal_tail(z["plain"]).alias("p_plain"))

        def of(values: Column) -> Column:
            """All sums in one pass over the values."""
            start = F.struct(*[F.lit(0.0).alias(c) for c in ("values", "squares", "products", "high", "changes", "before")], F.lit(False).alias("mixed"))

            def step(a: Column, v: Column) -> Column:
                changed = (a["before"] > 0) & ((v > middle) != (a["before"] > middle))
                return F.struct(
                    (a["values"] + v).alias("values"), (a["squares"] + v * v).alias("squares"), (a["products"] + v * a["before"]).alias("products"),
                    (a["high"] + (v > middle).cast("double")).alias("high"), (a["changes"] + changed.cast("double")).alias("changes"), v.alias("before"),
                    (a["mixed"] | ((a["before"] > 0) & (v != a["before"]))).alias("mixed"),
                )

            sums = F.aggregate(values, start, step)
            chi = squares * kinds / n - n
            return let(sums, lambda s: let(let(chi, lambda c: scores(s, c, values[0], s["before"])), judged))

        return let(F.transform(F.split(body, ""), lambda c: F.position(c, symbols).cast("double")), of)

    symbols, agree = _alphabet(body)
    return let(F.struct(symbols.alias("s"), agree.alias("a")), lambda e: tests(e["s"], e["a"]))


def scan(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, base, tokens) of every row: base spans, and long tokens no base span covers with their test results."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"))
    t = F.col("text")
    assign = _spans(t, t.rlike(ASSIGN), ASSIGN, 2, ASSIGN_CHARS, "assign")
    access = _spans(t, t.contains("AKIA"), ACCESS, 0, 16, "access")
    hexes = _spans(t, t.rlike(HEX), HEX, 0, 32, "hex")
    candidate = CANDIDATE % min_chars
    found = F.when(t.rlike(candidate), matches(t, candidate)).otherwise(F.array())
    rows = rows.select("doc_id", F.sort_array(F.concat(assign, access, hexes)).alias("base"), found.cast("array<struct<start:bigint,end:bigint,body:string>>").alias("found"))

    def new(base: Column, m: Column) -> Column:
        return ~F.exists(base, lambda b: (b["start"] <= m["start"]) & (b["end"] >= m["end"]))

    fresh = F.filter("found", lambda m: new(F.col("base"), m))
    tested = F.transform(fresh, lambda m: let(battery(m["body"]), lambda r: F.struct(m["start"], m["end"], r["p_random"], r["p_plain"])))
    return rows.select("doc_id", "base", tested.alias("tokens"))


def _bin(p: Column) -> Column:
    return F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * _BINS).cast("int")


def cut_off(scanned: DataFrame, level: float = BATTERY_LEVEL, false_rate: float = FALSE_RATE) -> tuple[float, int | None]:
    """(mean length, least bin of log p) to accept: Benjamini-Hochberg over the tokens of all rows.

    Each token's p-value is divided by its weight, its length over the mean length, so longer
    tokens, which the battery tells better, get more of the error budget. P-values are
    counted in bins of a hundredth of a power of ten and stand for their bin's upper end.
    """
    tokens = scanned.select(F.explode("tokens").alias("t")).select((F.col("t.end") - F.col("t.start")).alias("n"), "t.p_random", "t.p_plain")
    mean = tokens.agg(F.avg("n")).first()[0]
    if mean is None:
        return 1.0, None
    p = F.when(F.col("p_random") >= level, F.least(F.col("p_plain") * mean / F.col("n"), F.lit(1.0))).otherwise(1.0)
    bins = tokens.groupBy(_bin(p).alias("b")).agg(F.count("*").alias("c")).collect()  # at most 30,001 bins
    total, so_far, best = sum(r["c"] for r in bins), 0, None
    for r in sorted(bins, key=lambda r: -r["b"]):
        so_far += r["c"]
        if r["b"] > 0 and total * 10 ** (-r["b"] / _BINS) <= false_rate * so_far:
            best = r["b"]
    return float(mean), best


def find_secrets(docs: DataFrame, min_chars: int = MIN_CHARS, level: float = BATTERY_LEVEL, false_rate: float = FALSE_RATE) -> DataFrame:
    """(doc_id, spans, n_assign, n_access, n_hex, n_random) of every row; spans are sorted (start, kind, end).

    Kinds are numbers in ``KINDS``. The base kinds follow fixed patterns; ``random`` are other
    tokens of ``min_chars`` or more that no base span covers, that pass the battery at ``level``
    and are accepted at the false discovery rate over all rows. A null text is taken as
    empty and has no span; repeated rows each get theirs; other columns are not read.
    """
    scanned = stored(scan(docs, min_chars), "scanned")
    mean, least = cut_off(scanned, level, false_rate)

    def accepted(t: Column) -> Column:
        weighed = F.least(t["p_plain"] * mean / (t["end"] - t["start"]), F.lit(1.0))
        return (t["p_random"] >= level) & (_bin(weighed) >= (1 << 30 if least is None else least))

    random = F.transform(F.filter("tokens", accepted), lambda t: F.struct(t["start"], F.lit(KINDS.index("random")).alias("kind"), t["end"]))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    found = scanned.select("doc_id", F.sort_array(F.concat("base", random)).alias("spans"))
    return found.select("doc_id", "spans", *[count(k) for k in KINDS])


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))))


@query("op1_secret_scan")
def op1(t):
    found = find_secrets(t.documents)
    base = F.filter("spans", lambda s: s["kind"] != KINDS.index("random"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), "n_random")
