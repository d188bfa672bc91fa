"""Personal data: span generators, boosted trees over format and context, calibrated thresholds; built-ins only."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import table

KINDS = ("email", "ip", "card", "phone")

# Patterns of the base kinds.  They match what the plain greedy patterns match, but start only
# where a run of the pattern's first characters starts (or the last match ended) and never give
# characters back, so long runs cost linear time and constant stack.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Wider proposals of the same kinds; their spans may overlap the base ones and each other.
WIDER = (
    ("email", r"(?:\G|(?<![^\s@<>,;:\x22()\[\]]))[^\s@<>,;:\x22()\[\]]++@[^\s@<>,;:\x22()\[\]]++"),
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?[(\[{]at[)\]}]\x20?[A-Za-z0-9-]{1,63}+"
              r"(?:\x20?(?:[(\[{]dot[)\]}]|\.)\x20?[A-Za-z0-9-]{1,63}+){1,8}+"),
    ("phone", r"(?<![0-9+])\(?[0-9]{2,4}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{3,4}(?![0-9])"),
)
# What a text must hold for a pattern to match at all, tested before the pattern: base kinds, then WIDER.
NEEDS = ("@", "digit", "digit", "+", "@", "at", "digit")
CONTEXT_CHARS = 24
CONTEXT = {  # words that speak for a kind when they stand just before a span
    "email": "mail|contact|write|kontakt|correo|courriel",
    "ip": r"\bip\b|host|server|addr|login",
    "card": "card|visa|credit|karte|tarjeta|carte",
    "phone": r"tel|phone|call|fax|mobil|\bcell\b",
}
AGAINST = r"order|isbn|version|serial|invoice|\bref\b|\bid\b|\bno\b"
ROUNDS = 30
RATE = 0.3
MIN_PRECISION = 0.98  # a pattern's threshold keeps at least this share of right spans among those accepted
# Forms that the wide patterns are for, written from base spans: (proposal, kind of the base span, right, SQL of the
# form over ``v``, the span's value).  Those that are not right are numbers in the shape of an address or a phone.
DIGITS = "regexp_replace(v, '[^0-9]', '')"
AREA, NEXT, LAST = (f"substring(right({DIGITS}, 10), 1, length(right({DIGITS}, 10)) - 7)",
                    f"left(right({DIGITS}, 7), 3)", f"right({DIGITS}, 4)")
MADE = (
    (4, "email", 1, "concat(split_part(v, '@', 1), '@', replace(split_part(v, '@', 2), '.', ''))"),
    (4, "email", 1, "concat(split_part(v, '@', 1), '@', substring_index(split_part(v, '@', 2), '.', 1))"),
    (4, "email", 1, "translate(v, 'aeiou', '\u00e4\u00e9\u00ef\u00f6\u00fc')"),
    (4, "phone", 0, f"concat('2@', {DIGITS})"),
    (5, "email", 1, "concat(split_part(v, '@', 1), ' (at) ', replace(split_part(v, '@', 2), '.', ' (dot) '))"),
    (5, "email", 1, "concat(split_part(v, '@', 1), '[at]', replace(split_part(v, '@', 2), '.', '[dot]'))"),
    (5, "email", 1, "concat(split_part(v, '@', 1), ' (at) ', split_part(v, '@', 2))"),
    (5, "ip", 0, "concat('me (at) ', v)"),
    (6, "phone", 1, f"concat({AREA}, '-', {NEXT}, '-', {LAST})"),
    (6, "phone", 1, f"concat('(', {AREA}, ') ', {NEXT}, '-', {LAST})"),
    (6, "phone", 1, f"concat({AREA}, ' ', {NEXT}, ' ', {LAST})"),
    (6, "phone", 0, f"concat(left({DIGITS}, 2), '.', substring({DIGITS}, 3, 3), '.', substring({DIGITS}, 6, 3))"),
    (6, "phone", 0, f"concat(left({DIGITS}, 3), ' ', substring({DIGITS}, 4, 3), ' ', substring({DIGITS}, 7, 3))"),
    (6, "phone", 0, f"concat('20', left({DIGITS}, 2), ' ', {NEXT}, ' ', {LAST})"),
    (6, "phone", 0, f"concat('19', left({DIGITS}, 2), '-', {NEXT}, '-', {LAST})"),
    (6, "phone", 0, f"concat('20', left({DIGITS}, 2), ' ', {NEXT}, ' ', substring({DIGITS}, 3, 3))"),
    (6, "phone", 0, f"concat('19', left({DIGITS}, 2), '.', {NEXT}, '.', substring({DIGITS}, 3, 3))"),
)
YEAR, NO_DOT = 5, 0  # values of ``shape``: a phone's first group is a year, an address has no dot behind its sign
DOTLESS = 4  # the wide pattern that takes addresses without a dot: a word has to speak for those (``git@server``)
DOUBTED = (4, 6)  # wide patterns that a word of AGAINST speaks against; the bracketed form of 5 speaks for itself
# Texts whose base spans the forms are written from besides the corpus's own, so that a corpus without any has a model.
SEEDS = ("Write to jane.doe@example.com or call +1 626 555 5759 today", "jane@mail.example.org, +44 20 7946 0958.",
         "Our host 192.168.10.1 and j_doe42@mail7.example.co.uk; tel +49 30 1234567, thanks", "see (info@host2024.net) or +16265550199",
         "info1999@srv12345.example.com: 42nd@web99.example.org, 10.0.0.1")
SEED_WEIGHT = 100  # each counts as so many
# An address whose letters are of an alphabet, some of them not ASCII: base spans hold only a part of it.
ABROAD = r"^(?=.*[^\x00-\x7F])[\p{IsLatin}\p{IsGreek}\p{IsCyrillic}0-9._%+-]+@[\p{IsLatin}\p{IsGreek}\p{IsCyrillic}0-9.-]*[\p{L}0-9]$"
FEATURES = ("proposal", "kind", "head", "last", "digits", "chars", "seps", "brackets", "shape", "word_for", "word_against",
            "before", "after")
MOST_DIGITS = {"email": 3, "ip": 12, "card": 24, "phone": 16}  # larger counts of digits are one value


def found(text: Column, pattern: str, may: Column) -> Column:
    """array<struct<start, end, value>> of a pattern's matches, in code points, end exclusive.

    The pieces between matches give the gaps; texts without a match are only tested, those
    that can't hold one (``may``) not even that.
    """
    pieces = F.split(text, pattern, -1)
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.expr("cast(array() as array<struct<start: int, `end`: int, value: string>>)")
    zero = F.struct(F.lit(0).alias("pos"), none.alias("spans"))

    def step(acc, x):
        start = acc["pos"] + x["gap"]
        end = start + F.length(x["value"])
        span = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("pos"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    gaps = F.zip_with(F.slice(F.transform(pieces, F.length), F.lit(1), F.size(values)), values,
                      lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
    return F.when(may & text.rlike(pattern), F.aggregate(gaps, zero, step, lambda acc: acc["spans"])).otherwise(none)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True where the check digit of a run of digits is right."""
    turned = F.reverse(digits)

    def add(total, i):
        d = F.substring(turned, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """The checks that a base match must pass."""
    if kind == "ip":
        def small(part):
            bare = F.regexp_replace(part, "^0+", "")
            return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))

        return F.forall(F.split(value, r"\."), small)
    if kind == "card":
        d = digits_of(value)
        return F.when(F.length(d).between(13, 19), luhn(d)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits_of(value)).between(9, 15)
    return F.lit(True)


def checked(kind: str):
    return lambda s: valid(kind, s["value"])


def named(kind: str):
    return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("name"))


def with_proposals(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with ``_text``, one array of matches a pattern (``_m0`` ...) and the valid base spans a kind."""
    out = docs.withColumn("_text", F.coalesce(text, F.lit("")))
    t = F.col("_text")
    out = out.withColumns({"_has_@": F.contains(t, F.lit("@")), "_has_+": F.contains(t, F.lit("+")),
                           "_has_digit": t.rlike("[0-9]"),
                           "_has_at": F.contains(t, F.lit("(at")) | F.contains(t, F.lit("[at")) | F.contains(t, F.lit("{at"))})
    patterns = [BASE[k] for k in KINDS] + [p for _, p in WIDER]
    out = out.withColumns({f"_m{i}": found(t, p, F.col(f"_has_{need}")) for i, (p, need) in enumerate(zip(patterns, NEEDS))})
    return out.withColumns({f"_{k}": F.filter(f"_m{i}", checked(k)) for i, k in enumerate(KINDS)})


def char_class(c: Column) -> Column:
    """0 nothing, 1 white space, 2 letter, 3 digit, 4 anything else."""
    return (F.when(F.length(c) == 0, 0).when(c.rlike(r"^\s"), 1).when(c.rlike(r"^\p{L}"), 2)
            .when(c.rlike("^[0-9]"), 3).otherwise(4))


def shape(kind: str, value: Column) -> Column:
    """Of a phone: the digits of its first group, ``YEAR`` for 1900 to 2099.  Of an address: dots behind its sign."""
    if kind == "phone":
        first = F.regexp_extract(value, "[0-9]+", 0)
        return F.when(first.rlike("^(?:19|20)[0-9]{2}$"), YEAR).otherwise(F.least(F.length(first), F.lit(4)))
    if kind == "email":
        domain = F.substring_index(value, "@", -1)
        dots = F.length(F.regexp_replace(domain, r"[^.]", ""))
        return F.when(F.contains(value, F.lit("@")), F.least(dots, F.lit(2))).otherwise(1)
    return F.lit(0)


def described(number: int, kind: str, text: Column, spans: Column) -> Column:
    """Spans of one pattern with their features, all small integers; none tells whether the base checks hold."""
    def one(s):
        value = s["value"]
        lead = F.substring(text, F.greatest(s["start"] - CONTEXT_CHARS, F.lit(0)) + 1,
                           F.least(s["start"], F.lit(CONTEXT_CHARS)))
        before = F.substring(text, s["start"], F.when(s["start"] > 0, 1).otherwise(0))
        after = F.substring(text, s["end"] + 1, F.lit(1))
        lead = F.lower(lead)
        digits = F.length(digits_of(value))
        return F.struct(
            s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("name"),
            F.lit(number).alias("proposal"), F.lit(KINDS.index(kind)).alias("kind"),
            char_class(F.substring(value, F.lit(1), F.lit(1))).alias("head"),
            char_class(F.substring(value, F.length(value), F.lit(1))).alias("last"),
            F.least(digits, F.lit(MOST_DIGITS[kind])).alias("digits"),
            F.least(F.floor(F.length(value) / 8), F.lit(4)).cast("int").alias("chars"),
            F.least(F.length(F.regexp_replace(value, r"[^\x20.-]", "")), F.lit(3)).alias("seps"),
            value.rlike(r"[()\[\]{}]").cast("int").alias("brackets"),
            shape(kind, value).alias("shape"),
            lead.rlike(CONTEXT[kind]).cast("int").alias("word_for"),
            lead.rlike(AGAINST).cast("int").alias("word_against"),
            char_class(before).alias("before"), char_class(after).alias("after"),
            (value.rlike(ABROAD) if number == len(KINDS) else F.lit(False)).alias("abroad"))

    return F.transform(spans, one)


def with_candidates(docs: DataFrame, text: Column) -> DataFrame:
    """``with_proposals`` plus ``_base`` (start, end, kind of every base span) and ``_cand`` (all proposals, described)."""
    out = with_proposals(docs, text)
    base = F.concat(*[F.transform(f"_{k}", named(k)) for k in KINDS])
    kinds = list(KINDS) + [k for k, _ in WIDER]
    cand = F.concat(*[described(i, k, F.col("_text"), F.col(f"_m{i}")) for i, k in enumerate(kinds)])
    any_match = F.lit(False)
    for i in range(len(kinds)):
        any_match = any_match | (F.size(f"_m{i}") > 0)
    return out.withColumns({"_base": base, "_any": any_match}).withColumn(
        "_cand", F.when(F.col("_any"), cand).otherwise(F.slice(cand, 1, 0)))


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (b["start"] < a["end"])


@dataclass
class Trees:
    """Boosted trees as (feature, cut, left, right) tuples with leaf values, and a score threshold of each of their patterns."""

    bias: float
    trees: list
    thresholds: dict[int, float]

    def score(self, of) -> Column:
        """The trees' sum as a SQL expression over feature columns ``of(name)``."""
        def walk(node):
            if not isinstance(node, tuple):
                return F.lit(float(node))
            feature, cut, left, right = node
            return F.when(of(feature) <= cut, walk(left)).otherwise(walk(right))

        total = F.lit(float(self.bias))
        for tree in self.trees:
            total = total + walk(tree)
        return total


@dataclass
class Model:
    """Trees of the base patterns and of each wide one, so that none is fitted to another's proposals."""

    parts: list[Trees]

    def accepts(self, c: Column) -> Column:
        good = F.lit(False)
        for part in self.parts:
            least = {n: t for n, t in part.thresholds.items() if t < math.inf}
            if least:
                bound = F.lit(None).cast("double")
                for number, value in least.items():
                    bound = F.when(c["proposal"] == number, value).otherwise(bound)
                good = F.when(c["proposal"].isin(*least), part.score(lambda f: c[f]) >= bound).otherwise(good)
        return good


def boost(cells: list[dict], rounds: int = ROUNDS, rate: float = RATE, depth: int = 2) -> tuple[float, list]:
    """Gradient-boosted trees (logistic loss) on weighted feature cells: ``n`` spans of which ``right`` are right."""
    n = sum(c["n"] for c in cells)
    right = sum(c["right"] for c in cells)
    bias = math.log((right + 1.0) / (n - right + 1.0))
    score = [bias] * len(cells)
    trees: list = []
    for _ in range(rounds):
        grad, hess = [], []
        for c, s in zip(cells, score):
            p = 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, s))))
            grad.append(c["right"] - c["n"] * p)
            hess.append(max(c["n"] * p * (1 - p), 1e-6))
        tree = _tree(cells, grad, hess, list(range(len(cells))), depth, rate)
        if not isinstance(tree, tuple):
            break
        trees.append(tree)
        score = [s + _leaf_of(tree, c) for s, c in zip(score, cells)]
    return bias, trees


def _leaf_of(node, cell) -> float:
    while isinstance(node, tuple):
        node = node[2] if cell[node[0]] <= node[1] else node[3]
    return node


def _score(bias, trees, cell) -> float:
    """The score, added up in the order of the SQL expression (``sum`` rounds otherwise), so that it equals a threshold."""
    for t in trees:
        bias += _leaf_of(t, cell)
    return bias


def _tree(cells, grad, hess, rows, depth, rate):
    """The tree with the best Newton gains; a plain number where no split gains."""
    g, h = sum(grad[i] for i in rows), sum(hess[i] for i in rows)
    best = None
    for feature in FEATURES if depth else ():
        sums: dict[int, list[float]] = {}
        for i in rows:
            at = sums.setdefault(cells[i][feature], [0.0, 0.0])
            at[0] += grad[i]
            at[1] += hess[i]
        gl = hl = 0.0
        for cut in sorted(sums)[:-1]:
            gl, hl = gl + sums[cut][0], hl + sums[cut][1]
            gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
            if gain > 1e-9 and (best is None or gain > best[0]):
                best = (gain, feature, cut)
    if best is None:
        return rate * g / (h + 1)
    _, feature, cut = best
    left = [i for i in rows if cells[i][feature] <= cut]
    right = [i for i in rows if cells[i][feature] > cut]
    return (feature, cut, _tree(cells, grad, hess, left, depth - 1, rate),
            _tree(cells, grad, hess, right, depth - 1, rate))


def calibrated(cells: list[dict], bias: float, trees: list, numbers, min_precision: float = MIN_PRECISION) -> dict[int, float]:
    """For each pattern the lowest score at which its own spans at or above it are right often enough (none: infinite)."""
    out = {}
    for number in numbers:
        own = sorted(((_score(bias, trees, c), c["n"], c["right"])
                      for c in cells if c["proposal"] == number), reverse=True)
        n = right = 0
        out[number] = math.inf
        for at, (s, a, b) in enumerate(own):
            n, right = n + a, right + b
            if at + 1 < len(own) and own[at + 1][0] == s:
                continue
            if (right + 1) / (n + 2) >= min_precision:
                out[number] = s
    return out


def label(c: Column) -> Column:
    """1 right, 0 wrong, null unknown: what the text itself tells about a proposal.

    A base pattern's proposal is right if it overlaps a base span of its kind: the checks
    (Luhn, lengths, parts of an ip) tell how often its form and context hold the real thing.
    A wide one is not wrong for missing the base rule, which it is there to widen: it is
    wrong only where it overlaps a span of another kind, where a year leads it, or where no
    word speaks for it and one against it (``DOUBTED``) or it has no dot (``DOTLESS``).
    """
    own = F.exists("_base", lambda b: overlaps(c, b) & (c["name"] == b["name"]))
    other = F.exists("_base", lambda b: overlaps(c, b) & (c["name"] != b["name"]))
    doubted = c["proposal"].isin(*DOUBTED) & (c["word_against"] == 1) & (c["word_for"] == 0)
    dotless = (c["proposal"] == DOTLESS) & (c["shape"] == NO_DOT) & (c["word_for"] == 0)
    dated = (c["name"] == "phone") & (c["shape"] == YEAR)
    wide = F.when(other | doubted | dotless | dated, 0)
    return F.when(own, 1).otherwise(F.when(c["proposal"] < len(KINDS), 0).otherwise(wide))


def made() -> Column:
    """The forms of ``MADE`` written from every valid base span, described in the span's own context."""
    def written(number, kind, right, form):
        of, pattern = WIDER[number - len(KINDS)]
        value = re.sub(r"\bv\b", "s.value", form)
        spans = F.filter(F.expr(f"transform(_{kind}, s -> struct(s.start as start, s.`end` as `end`, {value} as value))"),
                         lambda s: s["value"].rlike(f"^(?:{pattern})$"))
        return F.transform(described(number, of, F.col("_text"), spans),
                           lambda c: F.struct(c.alias("c"), F.lit(right).alias("right"), F.lit(True).alias("made")))

    return F.concat(*[written(*m) for m in MADE])


def train(docs: DataFrame, text_col: str = "text") -> Model:
    """Fit on the proposals that ``label`` knows of one half of the texts, and calibrate on those of the other half.

    Both halves, dealt by a hash of the text (so copies stay together), also hold the forms of
    ``MADE``, written from the base spans of their texts and of ``SEEDS``, a fixed number a
    span.  A right one in a word's context that speaks against it (``DOUBTED``) counts as
    wrong as well, an address without a dot is right only where a word speaks for it, and a
    number in the shape of a phone counts as wrong where no word speaks for it, or anywhere
    if a year leads it.  So what is accepted does not depend on how many spans miss the base rule.

    Spark counts the proposals of each combination of features (an aggregate); the trees are
    grown on those counts.  The combinations are bounded by the features' ranges, whatever
    the input: below half a million a pattern if each occurred, some hundreds in the given tables.
    """
    own = docs.select(F.col(f"`{text_col}`").cast("string").alias("t"), F.lit(False).alias("seed"))
    seeds = docs.sparkSession.range(1, numPartitions=1).select(
        F.explode(F.array(*map(F.lit, SEEDS))).alias("t"), F.lit(True).alias("seed"))
    cand = with_candidates(own.unionByName(seeds), F.col("t")).filter("_any")
    marked = F.filter(F.transform("_cand", lambda c: F.struct(
        c.alias("c"), label(c).alias("right"), F.lit(False).alias("made"))), lambda x: x["right"].isNotNull())
    natural = F.when(F.col("seed"), F.slice(marked, 1, 0)).otherwise(marked)
    weight = F.when(F.col("seed"), SEED_WEIGHT).otherwise(1)
    half = F.when(F.col("seed"), 2).otherwise(F.pmod(F.xxhash64(F.lit("half"), "t"), F.lit(2))).cast("int")
    cells = (cand.select(F.explode(F.concat(natural, made())).alias("x"), weight.alias("w"), half.alias("half"))
             .groupBy(*[F.col(f"x.c.{f}").alias(f) for f in FEATURES], F.col("x.made").alias("made"), "half")
             .agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("x.right")).alias("right"))
             .orderBy(*FEATURES, "made", "half").collect())
    cells = [c.asDict() for c in cells]
    fitted, held = (merged([c for c in cells if c["half"] in (h, 2)]) for h in (0, 1))
    parts = []
    for numbers in (range(len(KINDS)), *([len(KINDS) + i] for i in range(len(WIDER)))):
        bias, trees = boost([c for c in fitted if c["proposal"] in numbers])
        parts.append(Trees(bias, trees, calibrated(held, bias, trees, numbers)))
    return Model(parts)


def merged(cells: list[dict]) -> list[dict]:
    """One cell a combination of features, with the wrong ones that made cells stand for in other contexts."""
    out: dict[tuple, dict] = {}

    def add(c, n, right, **context):
        c = {f: c[f] for f in FEATURES} | context
        at = out.setdefault(tuple(c.values()), c | {"n": 0, "right": 0})
        at["n"] += n
        at["right"] += right

    for c in cells:
        if not c["made"]:
            add(c, c["n"], c["right"])
            continue
        wrong = c["n"] - c["right"]
        if c["right"] and c["proposal"] == DOTLESS and c["shape"] == NO_DOT:
            for against in (0, 1):
                add(c, c["right"], c["right"], word_for=1, word_against=against)
                add(c, c["right"], 0, word_for=0, word_against=against)
        elif c["right"]:
            add(c, c["right"], c["right"])
            if c["proposal"] in DOUBTED:
                add(c, c["right"], 0, word_for=0, word_against=1)
        if wrong:
            add(c, wrong, 0, word_for=0)
            if c["kind"] == KINDS.index("phone") and c["shape"] == YEAR:
                add(c, wrong, 0, word_for=1)
    return list(out.values())


def with_spans(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` (its columns as ``_c0`` ...) with ``_spans``: array of (rank of kind, start, end, kind), and the base arrays.

    Every base span stays; a proposal that meets no base span joins where its score reaches its
    pattern's threshold, and so does an address with letters that are not ASCII which holds
    the base spans that it meets.
    """
    names = docs.columns
    out = with_candidates(docs.toDF(*[f"_c{i}" for i in range(len(names))]), F.col(f"_c{names.index(text_col)}"))

    def wanted(c):
        inside = F.forall("_base", lambda b: ~overlaps(c, b) | ((c["name"] == b["name"]) & (c["start"] <= b["start"])
                                                                & (c["end"] >= b["end"])))
        return (~F.exists("_base", lambda b: overlaps(c, b)) | (c["abroad"] & inside)) & model.accepts(c)

    def ranked(s):
        rank = F.lit(len(KINDS))
        for i, k in enumerate(KINDS):
            rank = F.when(s["name"] == k, i).otherwise(rank)
        return F.struct(rank.alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["name"].alias("name"))

    more = F.when(F.col("_any"), F.transform(F.filter("_cand", wanted), ranked))
    base = F.transform("_base", ranked)
    return out.withColumn("_spans", F.when(F.col("_any"), F.array_distinct(F.array_sort(F.concat(base, more))))
                          .otherwise(base))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span (overlapping ones together) replaced by its kind in brackets."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                             s["name"].alias("name"))))
    zero = F.struct(F.lit(0).alias("pos"), F.expr("cast(array() as array<string>)").alias("out"))

    def step(acc, s):
        fresh = F.array(F.substring(text, acc["pos"] + 1, s["start"] - acc["pos"]),
                        F.concat(F.lit("["), F.upper(s["name"]), F.lit("]")))
        return F.struct(F.greatest(acc["pos"], s["end"]).alias("pos"),
                        F.when(s["start"] >= acc["pos"], F.concat(acc["out"], fresh)).otherwise(acc["out"]).alias("out"))

    def finish(acc):
        return F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["pos"] + 1, F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(ordered, zero, step, finish)).otherwise(text)


def redact(docs: DataFrame, model: Model | None = None, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with the spans of its texts replaced and the count of characters renewed; null texts stay null."""
    names = docs.columns
    out = with_spans(docs, model or train(docs, text_col), text_col)
    at = f"_c{names.index(text_col)}"
    out = out.withColumn("_new", F.when(F.col(at).isNotNull(), redacted(F.col("_text"), F.col("_spans"))))
    picked = []
    for i, n in enumerate(names):
        c = F.col(f"_c{i}")
        if n == text_col:
            c = F.col("_new")
        elif n == chars_col:
            c = F.when(F.size("_spans") > 0, F.length("_new").cast(docs.schema[n].dataType)).otherwise(c)
        picked.append(c.alias(n))
    return out.select(*picked)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op10 over the whole ``documents`` table: counts and digest of the base spans, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = with_spans(docs, train(docs))
    base = F.array_join(F.transform("_base", lambda s: F.concat_ws(":", s["name"], s["start"], s["end"])), ",")
    return out.select(F.col("_c0").alias("doc_id"), *[F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in KINDS],
                      F.sha2(base, 256).alias("base_sha256"), joined(F.col("_spans")).alias("spans"))
