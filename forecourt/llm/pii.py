"""Personal data by boosted trees over candidate spans; built from SQL functions only.

High-recall generators propose spans that may overlap: the four base patterns, e-mail addresses with spelled-out
signs, and any grouped run of digits. A match of a base pattern that passes its check is
personal data and always stays. The other candidates are judged by boosted trees of depth two over format and
context: ``FEATURES`` (separators, groups of digits, words before the span; never the check itself, nor the number of
digits that it tests) and how much more often the word before the span stands before checked than before failed matches.

The trees learn from the matches of the base patterns: those that pass their check against those of the same shapes that fail
it, either side with half of the weight. Everything is cross-fitted: documents fall into two folds by a hash of their id,
and each is judged by the word odds and trees of the other one. As every feature is a bit, the
counts per fold and combination (at most 2 * 2 ** ``BITS`` rows, gathered by one aggregation) are all that
boosting needs; Newton steps on the log-loss run over these counts. The threshold is the lowest score of the other fold's trees
at and above which the share of checked spans, at equal weights, is ``PRECISION``; candidates at or above it that
touch no base span become spans of kind ``other``. With fewer than ``LEAST`` matches on a side in either fold nothing is added.

Positions are found with ``split``: the pieces between the matches and the matches have lengths that
add up; running sums are taken in blocks, so many matches in one long text stay cheap. Patterns are written
possessively, with the start of a run checked behind, which leaves their matches as they are and the time linear. The candidates are written once and read by all passes.
Positions count code points, ends are exclusive. Null and empty texts have no spans; rows are independent; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm import common
from forecourt.session import materialise

KINDS = ("email", "ip", "card", "phone", "other")
BASE = KINDS[:4]
_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
#: Name -> (pattern, what a text must hold for it to match). [fixed values]
PATTERNS = {
    "email": (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "contains(text, '@')"),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"text rlike '[0-9]\\.[0-9]'"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", "text rlike '[0-9](?:[- ]?[0-9]){15}'"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "contains(text, '+')"),
    "spelled": (
        r"[A-Za-z0-9._%+-]++\x20?[\[({]at[\])}]\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|[\[({]dot[\])}])\x20?[A-Za-z0-9-]++)++",
        r"text rlike '[\\[({]at[\\])}]'",
    ),
    "digits": (r"(?<![0-9A-Za-z])[(]?[0-9](?:[\x20().-]{0,2}[0-9]){6,}+(?![0-9A-Za-z])", "text rlike '[0-9](?:[- ().]{0,2}[0-9]){6}'"),
}
#: What a match m of a base pattern must pass; d holds its digits. [fixed values]
CHECKS = {
    "email": "true",
    "ip": f"m rlike '^{_BYTE}(?:\\\\.{_BYTE}){{3}}$'",
    "card": "length(d) between 16 and 19 and luhn_check(d)",
    "phone": "length(d) between 8 and 15",
}
#: Conditions over the match m, its digits d and the lowered text before it, b. [fixed values]
FEATURES = (
    "startswith(m, '+')", "contains(m, '(')", "m rlike '@|at'", "length(m) - length(d) >= 2", "m rlike '[.].*[.]'",
    "m rlike '[0-9]{4}[ -][0-9]{4}'", "m rlike '(^|[^0-9])[0-9]{3}[ .-][0-9]{4}($|[^0-9])'",
    "b rlike 'phone|tel|call|mobile|fax'", "b rlike 'card|visa|credit|account'", "b rlike 'mail|contact|write'", "b rlike 'host|server|address'",
    "b rlike '[a-z0-9=_\"/-]$'",
)
#: The last word of the text before the match, one of so many classes.
WORD = r"pmod(crc32(cast(regexp_extract(b, '(\\p{L}+)\\P{L}*$', 1) as binary)), 1024)"
WORDS = 1024
#: Bits set where the log-odds of the word before are above or below these.
ODDS = (1.0, 2.5, -1.0)
BITS = len(FEATURES) + len(ODDS)
FOLDS = 2
LEAST = 10
BEFORE = 24
TREES = 24
RATE = 0.3
PRECISION = 0.98


def _positions(name: str) -> str:
    """Matches with positions: array of (start, end, m, d, b) from the columns f_name and p_name."""
    f, p = f"f_{name}", f"p_{name}"
    step = f"transform(sequence(0, size({f}) - 1), i -> length({p}[i]) + length({f}[i]))"
    width = f"cast(ceil(sqrt(size({f}))) as int)"
    blocks = f"transform(sequence(0, (size({f}) - 1) div w), j -> aggregate(slice(s, 1, j * w), 0, (a, x) -> a + x))"
    # s: lengths of piece and match; w: width of a block; k: sum before each block
    inner = (
        f"transform(sequence(0, size({f}) - 1), i -> named_struct('m', {f}[i], 'b', lower(right({p}[i], {BEFORE})), "
        f"'start', k[i div w] + aggregate(slice(s, (i div w) * w + 1, i % w), 0, (a, x) -> a + x) + length({p}[i])))"
    )
    spans = _let("s", step, _let("w", width, _let("k", blocks, inner)))
    full = f"transform({spans}, x -> named_struct('start', x.start, 'end', x.start + length(x.m), 'm', x.m, 'd', regexp_replace(x.m, '[^0-9]', ''), 'b', x.b))"
    return f"case when size({f}) > 0 then {full} end"


def _let(name: str, value: str, body: str) -> str:
    """``body`` with the value computed once: a lambda over an array of one."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _bits(span: str) -> str:
    """The features of a span as the bits of a number."""
    terms = []
    for i, feature in enumerate(FEATURES):
        terms.append(f"case when {_bind(feature, span)} then {1 << i} else 0 end")
    return "(" + " + ".join(terms) + ")"


def _bind(condition: str, span: str) -> str:
    """A condition over m, d and b as one over the fields of a struct."""
    out, quoted = [], False
    for i, c in enumerate(condition):
        quoted ^= c == "'"
        alone = not quoted and c in "mdb" and not (condition[i - 1 : i] or " ").isalnum() and not (condition[i + 1 : i + 2] or " ").isalnum()
        out.append(f"{span}.{c}" if alone and condition[i - 1 : i] != "_" and condition[i + 1 : i + 2] != "_" else c)
    return "".join(out)


def candidates(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, fold, base (checked spans by kind), rest (the other candidates).

    base: array of (kind, start, end, bits, w) by kind, then start; rest: array of (start, end, bits, w, y), w the class of
    the word before, y 0 for matches that fail a check and null for others.
    """
    fold = F.coalesce(common.fold_of("doc_id", FOLDS), F.lit(0)).cast("int").alias("fold")
    frame = docs.select(F.col("doc_id").cast("bigint"), fold, F.coalesce("text", F.lit("")).alias("text"))
    quote = lambda p: p.replace("\\", "\\\\").replace("'", "\\'")
    none = "cast(array() as array<string>)"
    frame = frame.select("*", *[
        F.expr(f"case when {need} then regexp_extract_all(text, '{quote(p)}', 0) else {none} end").alias(f"f_{name}")
        for name, (p, need) in PATTERNS.items()
    ])
    frame = frame.select("doc_id", "fold", *[f"f_{n}" for n in PATTERNS], *[
        F.expr(f"case when size(f_{name}) > 0 then split(text, '{quote(p)}', -1) else {none} end").alias(f"p_{name}")
        for name, (p, _) in PATTERNS.items()
    ])
    frame = frame.select("doc_id", "fold", *[F.expr(_positions(name)).alias(f"s_{name}") for name in PATTERNS])
    base = [
        f"transform(filter(coalesce(s_{k}, array()), x -> {_bind(CHECKS[k], 'x')}), "
        f"x -> named_struct('kind', '{k}', 'start', x.start, 'end', x.end, 'bits', {_bits('x')}, 'w', {_bind(WORD, 'x')}))"
        for k in BASE
    ]
    other = "x -> named_struct('start', x.start, 'end', x.end, 'bits', {0}, 'w', {1}, 'y', {2})"
    failed = [f"filter(coalesce(s_{k}, array()), x -> not coalesce({_bind(CHECKS[k], 'x')}, false))" for k in ("ip", "card", "phone")]
    failed = f"transform(concat({', '.join(failed)}), {other.format(_bits('x'), _bind(WORD, 'x'), '0')})"
    more = f"transform(concat(coalesce(s_spelled, array()), coalesce(s_digits, array())), {other.format(_bits('x'), _bind(WORD, 'x'), 'cast(null as int)')})"
    frame = frame.select("doc_id", "fold", F.expr(f"concat({', '.join(base)})").alias("base"), F.expr(f"concat({failed}, {more})").alias("proposed"))
    apart = "filter(proposed, x -> not exists(base, y -> x.start < y.end and y.start < x.end))"
    return frame.select("doc_id", "fold", "base", F.expr(f"case when size(proposed) > 0 then {apart} else proposed end").alias("rest"))


def boost(counts: list[tuple[int, int, int]], n_features: int, trees: int = TREES, rate: float = RATE) -> list[tuple]:
    """Depth-two trees (first, second if unset, second if set, four leaves) from (bits, positives, negatives)."""
    score = [0.0] * len(counts)
    grown = []

    def sums(rows):
        g = h = 0.0
        for r in rows:
            bits, pos, neg = counts[r]
            p = 1 / (1 + math.exp(-score[r]))
            g += pos * (1 - p) - neg * p
            h += (pos + neg) * p * (1 - p)
        return g, h

    def gain(rows):
        g, h = sums(rows)
        return g * g / (h + 1.0)

    def parted(rows, feature):
        return [r for r in rows if not counts[r][0] >> feature & 1], [r for r in rows if counts[r][0] >> feature & 1]

    def best(rows):
        return max(range(n_features), key=lambda f: (sum(map(gain, parted(rows, f))), -f))

    everything = list(range(len(counts)))
    for _ in range(trees):
        top = best(everything)
        low, high = parted(everything, top)
        left, right = best(low), best(high)
        leaves = [*parted(low, left), *parted(high, right)]
        values = []
        for rows in leaves:
            g, h = sums(rows)
            values.append(rate * g / (h + 1.0))
        for rows, value in zip(leaves, values, strict=True):
            for r in rows:
                score[r] += value
        grown.append((top, left, right, *values))
    return grown


def tree_score(grown: list[tuple], bits: int) -> float:
    total = 0.0
    for top, left, right, *leaves in grown:
        high = bits >> top & 1
        total += leaves[2 * high + (bits >> (right if high else left) & 1)]
    return total


def calibrated(scored: list[tuple[float, float, float]], precision: float = PRECISION) -> float:
    """The lowest score at and above which checked spans make up the precision, at equal weights of both sides; infinite if none does.

    scored: (score, weight of checked, weight of failed).
    """
    ranked = sorted(scored, reverse=True)
    all_good, all_bad = sum(r[1] for r in ranked) or 1.0, sum(r[2] for r in ranked) or 1.0
    found, good, bad = math.inf, 0.0, 0.0
    for i, (score, p, n) in enumerate(ranked):
        good, bad = good + p / all_good, bad + n / all_bad
        if (i + 1 == len(ranked) or ranked[i + 1][0] < score) and good >= precision * (good + bad):
            found = score
    return found


def word_bits(good: dict[int, int], bad: dict[int, int]) -> list[int]:
    """Per class of words the bits of its log-odds, from counts before checked and failed matches; unseen words have odds of 1."""
    all_good, all_bad = sum(good.values()), sum(bad.values())
    prior = 2 / (all_good + all_bad)
    out = []
    for w in range(WORDS):
        odds = math.log((good.get(w, 0) / all_good + prior) / (bad.get(w, 0) / all_bad + prior))
        out.append(sum(1 << (len(FEATURES) + i) for i, edge in enumerate(ODDS) if (odds > edge > 0) or (odds < edge < 0)))
    return out


def score_sql(grown: list[tuple], bits: str) -> str:
    bit = lambda f: f"({bits} & {1 << f}) <> 0"
    trees = [
        f"case when {bit(top)} then case when {bit(right)} then {leaves[3]!r}D else {leaves[2]!r}D end "
        f"else case when {bit(left)} then {leaves[1]!r}D else {leaves[0]!r}D end end"
        for top, left, right, *leaves in grown
    ]
    return " + ".join(trees) or "0.0D"


def with_odds(bits: str, word: str, fold: str, odds: list[list[int]]) -> str:
    """The bits of a span with those of the word before, from the other folds' counts."""
    flat = ", ".join(str(code) for codes in odds for code in codes)
    return f"({bits} | get(array({flat}), cast({fold} * {WORDS} + {word} as int)))"


def learn(found: DataFrame, precision: float = PRECISION) -> tuple[list[list[int]], list[list[tuple]], float]:
    """Per fold the word bits and trees learned from the other fold, and the threshold, from the output of ``candidates``."""
    label = "concat(transform(base, x -> named_struct('bits', x.bits, 'w', x.w, 'y', 1)), transform(filter(rest, x -> x.y = 0), x -> named_struct('bits', x.bits, 'w', x.w, 'y', 0)))"
    each = found.select("fold", F.explode(F.expr(label)).alias("c")).select("fold", "c.*")
    # at most 2 * FOLDS * WORDS rows
    rows = each.groupBy("fold", "w", "y").agg(F.count(F.lit(1)).alias("n")).collect()
    seen = [[{r["w"]: r["n"] for r in rows if r["fold"] == f and r["y"] == y} for y in (0, 1)] for f in range(FOLDS)]
    nothing = [[0] * WORDS] * FOLDS, [[]] * FOLDS, math.inf
    if any(sum(side.values()) < LEAST for fold in seen for side in fold):
        return nothing
    odds = [word_bits(seen[1 - f][1], seen[1 - f][0]) for f in range(FOLDS)]
    # a fold's own matches, with the bits they have when the other fold's words judge them
    joined = each.withColumn("bits", F.expr(with_odds("bits", "w", "fold", odds)))
    rows = joined.groupBy("fold", "bits").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n")).orderBy("fold", "bits").collect()
    counts = [[(r["bits"], r["p"], r["n"]) for r in rows if r["fold"] == f] for f in range(FOLDS)]
    grown = [boost(balanced(counts[1 - f]), BITS) for f in range(FOLDS)]
    scored = [(tree_score(grown[f], bits), p, n) for f in range(FOLDS) for bits, p, n in balanced(counts[f])]
    return odds, grown, calibrated(scored, precision)


def balanced(counts: list[tuple[int, int, int]]) -> list[tuple[int, float, float]]:
    """The counts with the lighter side weighed up to the other."""
    good, bad = sum(c[1] for c in counts), sum(c[2] for c in counts)
    return [(bits, p * max(1.0, bad / good), n * max(1.0, good / bad)) for bits, p, n in counts]


def find_personal(docs: DataFrame, precision: float = PRECISION) -> DataFrame:
    """Per document row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_other, n_spans."""
    found = materialise(candidates(docs), "candidates")
    odds, grown, threshold = learn(found, precision)
    chosen = "cast(array() as array<struct<start:int,end:int,bits:int>>)"
    if threshold < math.inf:
        bits = _let("bits", with_odds("x.bits", "x.w", "fold", odds), "{0}")
        scores = " ".join(f"when {f} then {bits.replace('{0}', score_sql(grown[f], 'bits'))}" for f in range(FOLDS))
        good = f"filter(rest, x -> case fold {scores} end >= {threshold!r}D)"
        # several generators may propose one span, and spans that overlap: the first, longest one counts
        chosen = (
            f"aggregate(array_sort(transform({good}, x -> named_struct('start', x.start, 'far', -x.end))), "
            "named_struct('to', -1, 'kept', cast(array() as array<struct<start:int,far:int>>)), "
            "(a, x) -> case when x.start >= a.to then named_struct('to', -x.far, 'kept', array_append(a.kept, x)) else a end, "
            "a -> transform(a.kept, x -> named_struct('start', x.start, 'end', -x.far, 'bits', 0)))"
        )
    frame = found.select("doc_id", "base", F.expr(f"case when size(rest) > 0 then {chosen} else array() end").alias("more"))
    text = "array_join(transform({0}, x -> concat({1}, ':', x.start, ':', x.end)), ',')"
    frame = frame.select(
        "*", F.expr(text.format("base", "x.kind")).alias("base_text"), F.expr(text.format("more", "'other'")).alias("more_text")
    )
    count = lambda k: F.expr(f"cast(size(filter(base, x -> x.kind = '{k}')) as bigint)").alias(f"n_{k}")
    return frame.select(
        "doc_id", *[count(k) for k in BASE], F.sha2("base_text", 256).alias("base_sha256"),
        F.concat_ws(",", F.nullif("base_text", F.lit("")), F.nullif("more_text", F.lit(""))).alias("spans"),
        F.size("more").cast("bigint").alias("n_other"), (F.size("base") + F.size("more")).cast("bigint").alias("n_spans"),
    )
