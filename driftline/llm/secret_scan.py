"""Secret scans with DataFrame functions only: three base patterns and a battery of randomness tests.

The battery looks at every long token.  From its characters an encoding, and with it an alphabet, is inferred; then

* a chi-squared statistic tests whether the alphabet is used uniformly,
* a runs test looks at changes between the lower and the upper half of the alphabet,
* a serial correlation tests whether neighbouring characters depend on each other.

Fisher's method joins the three to the p-value of "random".  A model of neighbouring characters, counted over the distinct
tokens of the corpus itself, tells how likely ordinary text is to write the token.  The statistic of a token is the
likelihood ratio of random against ordinary in bits, lowered by the bits of its battery p-value: an ordinary token reaches
t bits with a chance of 2^-t at most, and one that fails the battery loses what it gained by rare neighbours.
Benjamini-Hochberg on these p-values, over the distinct tokens of each band of lengths, sets the threshold.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftline.functions.vectors import doubles
from driftline.session import stored

# The base patterns.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

_RUN = "A-Za-z0-9+/_-"
TOKEN = f"(?<![{_RUN}])[{_RUN}]{{20,}}={{0,2}}"
# Shorter tokens count for the model of ordinary neighbours too.
MODEL_TOKEN = f"[{_RUN}]{{10,}}"

_DIGITS, _LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
_UPPER = _LOWER.upper()
# Encoding, pattern of the whole token, alphabet; the first that fits is taken.  Plain numbers are no candidates.
ENCODINGS = (
    ("hex", "^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("hex-upper", "^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("lower", "^[a-z]+$", _LOWER),
    ("base32", "^[A-Z2-7]+$", _UPPER + "234567"),
    ("base36", "^[a-z0-9]+$", _DIGITS + _LOWER),
    ("base62", "^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGITS),
    ("base64", "^[A-Za-z0-9+/]+$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", "^[A-Za-z0-9_-]+$", _UPPER + _LOWER + _DIGITS + "-_"),
    ("mixed", "", _UPPER + _LOWER + _DIGITS + "+/-_"),
)
ALL = ENCODINGS[-1][2]
PRIOR = 8.0  # weight of single characters where a character has been seen with few neighbours
BANDS = (20, 32, 48, 64, 128)  # lower bounds of the length bands
FDR = 0.01
SUSPECT = 0.01  # battery p-value from which a token with a positive gain is left out of the model of ordinary ones
STEPS, STEP_LIMIT = 10, 400  # p-values are compared at 10 steps for each power of ten, down to 1e-40


def _spans(text: Column, pattern: str, group: int | None = None, least: int = 0) -> Column:
    """Places of a pattern as structs of code-point offsets, from the pieces between its matches.

    With ``group``, only matches whose group has ``least`` characters; the others still use up their text.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    size = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    steps = F.zip_with(
        F.zip_with(F.split(text, pattern, -1), whole, lambda p, m: F.struct(p.alias("before"), m.alias("match"))),
        size,
        lambda s, g: F.struct(
            F.char_length(s["before"]).alias("before"), F.char_length(s["match"]).alias("length"),
            F.char_length(g).alias("size"), s["match"].alias("match"),
        ),
    )
    # The last piece has no match: its length is null and it is left out.
    closed = F.filter(steps, lambda s: s["length"].isNotNull())
    placed = _let(closed, _offsets)
    return F.transform(
        F.filter(placed, lambda s: s["size"] >= least),
        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["match"].alias("match")),
    )


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _offsets(steps: Column) -> Column:
    """Steps with their start and end.  Sums run inside blocks of about the square root of their number, then over the
    blocks, since an array that grows step by step is copied at every step."""
    fields = "start int, end int, size int, match string"
    empty = F.expr(f"cast(array() AS array<struct<{fields.replace(' int', ': int').replace(' string', ': string')}>>)")

    def step(acc: Column, s: Column) -> Column:
        begin = acc["at"] + s["before"]
        end = begin + s["length"]
        place = F.struct(begin.alias("start"), end.alias("end"), s["size"].alias("size"), s["match"].alias("match"))
        return F.struct(end.alias("at"), F.array_append(acc["found"], place).alias("found"))

    def block(steps: Column) -> Column:
        return F.aggregate(steps, F.struct(F.lit(0).alias("at"), empty.alias("found")), step)

    def moved(pair: Column) -> Column:
        return F.transform(
            pair["b"]["found"],
            lambda s: F.struct(
                (s["start"] + pair["o"]).alias("start"), (s["end"] + pair["o"]).alias("end"), s["size"].alias("size"), s["match"].alias("match")
            ),
        )

    def joined(blocks: Column) -> Column:
        none = F.struct(F.lit(0).alias("at"), F.expr("cast(array() AS array<int>)").alias("before"))
        before = F.aggregate(
            blocks, none, lambda acc, b: F.struct((acc["at"] + b["at"]).alias("at"), F.array_append(acc["before"], acc["at"]).alias("before")),
            lambda acc: acc["before"],
        )
        return F.flatten(F.transform(F.zip_with(blocks, before, lambda b, o: F.struct(b.alias("b"), o.alias("o"))), moved))

    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(steps))).cast("int"))
    blocks = F.transform(F.sequence(F.lit(1), F.size(steps), width), lambda i: block(F.slice(steps, i, width)))
    return F.when(F.size(steps) > 0, _let(blocks, joined)).otherwise(empty)


def _gated(gate: Column, spans: Column) -> Column:
    return F.when(gate, spans).otherwise(F.expr("cast(array() AS array<struct<start: int, end: int, match: string>>)"))


def normal_tail(z: Column) -> Column:
    """P(Z > z) for any z, accurate in relative terms far out (the asymptotic series beyond 3)."""
    a = F.abs(z)
    # Abramowitz & Stegun 7.1.26, for |z| up to 3.
    t = 1.0 / (1.0 + 0.3275911 / math.sqrt(2.0) * a)
    poly = F.lit(0.0)
    for c in (1.061405429, -1.453152027, 1.421413741, -0.284496736, 0.254829592):
        poly = (poly + c) * t
    near = poly * F.exp(-a * a / 2.0) / 2.0
    far = F.exp(-a * a / 2.0) / (a * math.sqrt(2.0 * math.pi)) * (1.0 - 1.0 / (a * a) + 3.0 / (a * a * a * a))
    tail = F.when(a <= 3.0, near).otherwise(far)
    return F.when(z >= 0.0, tail).otherwise(1.0 - tail)


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2.0 * normal_tail(F.abs(z)))


def neighbour_bits(tokens: DataFrame) -> list[float]:
    """Bits −log2 P(b | a) of every pair of characters in ordinary tokens, then those of single characters.

    ``tokens`` has the distinct tokens (``match``); at most one row per pair reaches the driver.  Each pair and each
    character counts once less, for the token that is judged; single characters fill in where that leaves little.
    """
    body = F.regexp_replace("match", "=+$", "")
    pairs = tokens.select(F.explode(F.transform(F.sequence(F.lit(1), F.char_length(body) - 1), lambda i: F.substr(body, i, F.lit(2)))).alias("pair"))
    size, place = len(ALL), {c: i for i, c in enumerate(ALL)}
    counts = [0] * (size * size)
    for r in pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[place[r["pair"][0]] * size + place[r["pair"][1]]] = r["n"]
    single = [sum(counts[b::size]) + 1.0 for b in range(size)]
    whole = sum(single)
    bits = []
    for a in range(size):
        own = counts[a * size : (a + 1) * size]
        total = max(sum(own) - 1, 0) + PRIOR
        bits += [-math.log2((max(n - 1, 0) + PRIOR * s / whole) / total) for n, s in zip(own, single)]
    return bits + [-math.log2(s / whole) for s in single]


def battery(tokens: Column, bits: list[float]) -> Column:
    """For each place of a token: start, end, encoding, band, p_uniform (joined tests), gain (bits of random over ordinary)
    and step, the gain less the bits of p_uniform in STEPS for each power of ten.

    Steps are separate transforms, so that each value is worked out once.
    """
    ordinary, size = doubles(bits), len(ALL)

    def inferred(c: Column) -> Column:
        body = F.regexp_replace(c["match"], "=+$", "")
        name = F.lit(ENCODINGS[-1][0])
        letters = F.lit(ENCODINGS[-1][2])
        for encoding, pattern, alphabet in reversed(ENCODINGS[:-1]):
            name = F.when(body.rlike(pattern), F.lit(encoding)).otherwise(name)
            letters = F.when(body.rlike(pattern), F.lit(alphabet)).otherwise(letters)
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), body.alias("body"), name.alias("encoding"), letters.alias("letters"))

    def counted(c: Column) -> Column:
        body, letters = c["body"], c["letters"]
        n, k = F.char_length(body).cast("double"), F.char_length(letters).cast("double")
        chars = F.split(body, "")
        squares = F.aggregate(
            F.array_distinct(chars), F.lit(0.0), lambda a, d: a + F.pow(n - F.char_length(F.replace(body, d, F.lit(""))), 2.0)
        )
        return F.struct(
            c["start"].alias("start"), c["end"].alias("end"), c["encoding"].alias("encoding"), n.alias("n"), k.alias("k"),
            squares.alias("squares"), F.transform(chars, lambda x: (F.instr(letters, x) - 1).cast("double")).alias("codes"),
            F.transform(chars, lambda x: F.instr(F.lit(ALL), x) - 1).alias("places"),
        )

    def moments(c: Column) -> Column:
        codes, n, k = c["codes"], c["n"], c["k"]
        mean = F.aggregate(codes, F.lit(0.0), lambda a, x: a + x) / n
        low = F.transform(codes, lambda x: x < k / 2.0)
        changes = F.aggregate(
            F.zip_with(F.slice(low, 1, F.size(low) - 1), F.slice(low, 2, F.size(low) - 1), lambda a, b: F.when(a != b, 1.0).otherwise(0.0)),
            F.lit(1.0), lambda a, x: a + x,
        )
        return F.struct(
            *[c[f].alias(f) for f in ("start", "end", "encoding", "n", "k", "squares", "codes", "places")], mean.alias("mean"),
            F.size(F.filter(low, lambda x: x)).cast("double").alias("n_low"), changes.alias("runs"),
        )

    def tested(c: Column) -> Column:
        codes, n, k, mean = c["codes"], c["n"], c["k"], c["mean"]
        spread = F.aggregate(codes, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean))
        lagged = F.aggregate(
            F.zip_with(F.slice(codes, 1, F.size(codes) - 1), F.slice(codes, 2, F.size(codes) - 1), lambda a, b: (a - mean) * (b - mean)),
            F.lit(0.0), lambda a, x: a + x,
        )
        chi = k / n * c["squares"] - n
        z_chi = (chi - (k - 1.0)) / F.sqrt(2.0 * (k - 1.0) * (n - 1.0) / n)
        mu = 2.0 * c["n_low"] * (n - c["n_low"]) / n + 1.0
        var = (mu - 1.0) * (mu - 2.0) / (n - 1.0)
        z_runs = F.when(var > 0, (c["runs"] - mu) / F.sqrt(var)).otherwise(9.0)
        z_serial = F.when(spread > 0, (lagged / spread + 1.0 / n) * F.sqrt(n)).otherwise(9.0)
        places = c["places"]
        written = F.aggregate(
            F.zip_with(
                F.slice(places, 1, F.size(places) - 1), F.slice(places, 2, F.size(places) - 1), lambda a, b: F.get(ordinary, a * size + b)
            ),
            F.get(ordinary, F.get(places, F.lit(0)) + size * size), lambda a, x: a + x,
        )
        return F.struct(
            *[c[f].alias(f) for f in ("start", "end", "encoding", "n")],
            z_chi.alias("z_chi"), z_runs.alias("z_runs"), z_serial.alias("z_serial"), (written - n * F.log2(k)).alias("gain"),
        )

    def judged(c: Column) -> Column:
        p = [normal_tail(c["z_chi"]), _two_sided(c["z_runs"]), _two_sided(c["z_serial"])]
        x = -sum((F.log(F.greatest(q, F.lit(1e-300))) for q in p), F.lit(0.0))
        band = F.lit(0)
        for i, least in enumerate(BANDS):
            band = F.when(c["n"] >= least, F.lit(i)).otherwise(band)
        return F.struct(
            c["start"].alias("start"), c["end"].alias("end"), c["encoding"].alias("encoding"), band.alias("band"),
            x.alias("x"), c["gain"].alias("gain"),
        )

    def joined(c: Column) -> Column:
        # Fisher's sum of three has a chi-squared distribution with six degrees of freedom.
        x = c["x"]
        return F.struct(
            *[c[f].alias(f) for f in ("start", "end", "encoding", "band", "gain")],
            (F.exp(-x) * (1.0 + x + x * x / 2.0)).alias("p_uniform"),
        )

    def stepped(c: Column) -> Column:
        bits = c["gain"] + F.log2(F.greatest(c["p_uniform"], F.lit(1e-300)))
        step = F.floor(bits * (STEPS * math.log10(2.0))).cast("int")
        return F.struct(
            *[c[f].alias(f) for f in ("start", "end", "encoding", "band", "gain", "p_uniform")],
            F.greatest(F.lit(0), F.least(F.lit(STEP_LIMIT), step)).alias("step"),
        )

    found = tokens
    for stage in (inferred, counted, moments, tested, judged, joined, stepped):
        found = F.transform(found, stage)
    return found


def thresholds(histogram: list[tuple[int, int, int]], fdr: float = FDR) -> dict[int, int]:
    """For each length band the smallest step at which Benjamini-Hochberg still rejects "ordinary"; bands in which
    it never does are left out.  ``histogram`` has (band, step, tokens)."""
    found = {}
    for band in {b for b, _, _ in histogram}:
        own = sorted(((s, n) for b, s, n in histogram if b == band), reverse=True)
        total, below = sum(n for _, n in own), 0
        for step, n in own:
            below += n
            if total * 10.0 ** (-step / STEPS) <= fdr * below:
                found[band] = step
    return found


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row but the text with its ``places``: all detections as structs (start, kind, end) in order of start.

    Kinds are numbers in KINDS.  ``n_assign``, ``n_access`` and ``n_hex`` count the base kinds, ``base_sha256`` and
    ``spans`` write places as kind:start:end.  A null text is empty and has no places; repeated rows repeat.
    Columns of ``docs`` named like results are replaced.
    """
    names = ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "places")
    keep = [c for c in docs.columns if c not in names and c != text]
    body = F.coalesce(F.col("__text"), F.lit(""))
    low = F.lower(body)
    keyword = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api")
    sign = body.contains(":") | body.contains("=")
    scanned = docs.select(*keep, F.col(text).alias("__text")).select(
        *keep,
        _gated(keyword & sign, _spans(body, ASSIGN, 2, ASSIGN_LEAST)).alias("__assign"),
        _gated(body.contains("AKIA"), _spans(body, ACCESS)).alias("__access"),
        _gated(body.rlike(HEX), _spans(body, HEX)).alias("__hex"),
        _gated(body.rlike(TOKEN), _spans(body, TOKEN)).alias("__tokens"),
    )
    plain = "^[0-9]+=*$"  # plain numbers are no candidates
    tried = stored(scanned.withColumn("__tokens", F.filter("__tokens", lambda c: ~c["match"].rlike(plain))), "secrets")
    # Distinct tokens: a key that stands in many documents counts once, for the model as for the control.
    words = docs.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(MODEL_TOKEN), F.lit(0))).alias("match"))
    words = stored(words.filter(~F.col("match").rlike(plain)).distinct(), "secret-words")
    place = F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.col("match").alias("match"))
    judge = lambda bits: F.get(battery(F.array(place), bits), F.lit(0))
    # Counted twice: what looks random to the first model is no ordinary token and leaves the second one.
    looks = words.withColumn("t", judge(neighbour_bits(words)))
    bits = neighbour_bits(looks.filter((F.col("t.gain") <= 0) | (F.col("t.p_uniform") < SUSPECT)).select("match"))
    distinct = tried.select(F.explode("__tokens.match").alias("match")).distinct()
    tries = distinct.select(judge(bits).alias("t")).groupBy("t.band", "t.step").agg(F.count(F.lit(1)).alias("n"))
    limits = thresholds([(r["band"], r["step"], r["n"]) for r in tries.collect()])  # at most bands x steps rows
    tried = tried.withColumn("__tried", battery(F.col("__tokens"), bits)).drop("__tokens")

    def random_enough(c: Column) -> Column:
        least = F.lit(STEP_LIMIT + 1)
        for band, step in limits.items():
            least = F.when(c["band"] == band, F.lit(step)).otherwise(least)
        return c["step"] >= least

    def placed(column: Column, kind: int) -> Column:
        return F.transform(column, lambda c: F.struct(c["start"].alias("start"), F.lit(kind).alias("kind"), c["end"].alias("end")))

    base = F.concat(*[placed(F.col(f"__{k}"), i) for i, k in enumerate(KINDS[:3])])
    chance = placed(F.filter("__tried", random_enough), 3)
    kinds = F.array(*[F.lit(k) for k in KINDS])

    def written(places: Column) -> Column:
        parts = F.transform(places, lambda c: F.concat_ws(":", F.element_at(kinds, c["kind"] + 1), c["start"].cast("string"), c["end"].cast("string")))
        return F.array_join(parts, ",")

    ordered = tried.select(
        *keep,
        *[F.size(f"__{k}").cast("bigint").alias(f"n_{k}") for k in KINDS[:3]],
        F.array_sort(base).alias("__base"),
        F.array_sort(F.concat(base, chance)).alias("places"),
    )
    return ordered.select(
        *keep, "n_assign", "n_access", "n_hex", F.sha2(written(F.col("__base")), 256).alias("base_sha256"),
        written(F.col("places")).alias("spans"), "places",
    )
