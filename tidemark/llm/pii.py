"""Personal data by weak supervision, with DataFrame functions only.

Candidates come from patterns of four kinds (email, ip, card, phone): the base pattern of each kind, and wider forms
that people also write (spelled-out addresses, ips with guarded dots, cards in groups parted by other marks, phone
numbers without a country code or with 00 before it).  Labelers vote on every candidate - the pattern's own check, gazetteers (top-level domains, issuer and country prefixes), words of the context,
and the characters at the borders - or abstain.  Expectation-maximisation estimates each labeler's reliability for
each kind and a probability for each candidate, from the counts of vote patterns; a logistic span classifier is then
trained on the candidates' features with these probabilities.  A base match that passes its check always stays, and
nothing that fails one does; wider forms are added when the classifier accepts them and no base span overlaps.

Plan.  One pass over the texts finds candidates, as arrays beside each row: nothing is shuffled by document.  What is
learnt from is a grouped count whose keys are bounded (kinds * forms * votes * sides * sizes, at most 4 * 3 * 3^4 * 4^3
rows), so the driver's part does not grow with the corpus.  Offsets, overlaps and cuts are running sums and running
bounds over the arrays, taken in blocks of the square root of their length, so a text with many thousand matches takes
time little above its length.

Cases.  Null and empty texts have no spans.  Texts of any length are searched whole.  Start and end count code points, end exclusive.  Ids may be null or
repeat: one row comes out for each row.  An empty table gives an empty result, and the classifier then accepts what
the labelers' starting reliabilities accept.  Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("check", "gazetteer", "context", "border")

# The base patterns, written so that Java's matcher neither recurses nor starts again inside a run that has failed:
# a match begins where a run begins or where the last match ended (\G), and repeats are possessive.
_PATTERNS = (
    ("email", True, r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", True, r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", True, r"[0-9](?:[\x20-]?[0-9]){13,}+"),
    ("phone", True, r"\+[0-9][\x20().0-9-]+[0-9]"),
    (
        "email", False,
        r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:\[at\]|\(at\)|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}"
        r"(?:\x20?(?:\[dot\]|\(dot\)|\x20dot\x20)\x20?[A-Za-z0-9-]{1,63}){1,4}",
    ),
    (
        "ip", False,
        r"(?i)(?<![0-9.])[0-9]{1,3}(?:\x20?(?:\[\.\]|\(\.\)|\[dot\]|\(dot\)|\x20dot\x20)\x20?[0-9]{1,3}){3}(?![0-9])",
    ),
    ("card", False, r"(?<![0-9._/])[0-9]{4}([._/\t\xA0])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9])"),
    (
        "phone", False,
        r"(?<![0-9+.-])(?<!\+[0-9]\x20)(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    ),
    ("phone", False, r"(?<![0-9+.-])00[1-9][0-9]{0,2}(?:[\x20.-][0-9]{2,5}){2,5}(?![0-9])"),
)

# What a text must hold for each pattern to match anywhere (SQL): most texts need no pattern at all.
_NEEDS = (
    "contains(text, '@')",
    "digit",
    "digit",
    "contains(text, '+')",
    "dotted",
    "digit and (dotted or contains(text, '[.]') or contains(text, '(.)'))",
    "digit",
    "digit",
    "contains(text, '00')",
)

# Gazetteers and words of the context: fixed values.
_DOMAINS = (
    "com net org edu gov mil int info biz name io co de fr es uk us ca it nl ch at eu be pl pt se no dk fi ie au nz jp cn in br mx ru za"
    " kr tw hk sg tr gr cz hu ro ua il ar cl lu is app dev online site shop tech xyz me tv cc example"
)
_NEAR = (
    "mail e-mail email mailto contact contacts write address reach phone tel telephone mobile cell fax call sms text whatsapp"
    " card visa mastercard amex discover credit debit payment charge host server ip login client address addr"
    " telefon handy karte kreditkarte anrufen schreiben adresse kontakt courriel appeler appelez carte bancaire adresse joindre"
    " correo llamar llame tarjeta contacto escribir movil"
)
_AGAINST = "token hash sha md5 uuid key commit checksum version isbn issn doi build release order invoice serial tracking sku id"
_CARD_PREFIX = r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6(?:011|4[4-9]|5)|35)"
_PHONE_PREFIX = r"^\+(?:1|7|20|27|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"


def _word(words: str) -> str:
    return r"(?i)(?:^|[^\p{L}])(?:" + "|".join(words.split()) + r")(?:[^\p{L}]|$)"


def _luhn(digits: str) -> str:
    """SQL: whether a string of digits passes the Luhn check."""
    doubled = f"cast(substring({digits}, -k, 1) as int) * (1 + (k + 1) % 2)"
    return f"aggregate(sequence(1, length({digits})), 0L, (sum, k) -> sum + ({doubled}) div 10 + ({doubled}) % 10) % 10 = 0"


_LONGS = "cast(array() as array<bigint>)"


def _running(values: str, merge: str, start: str) -> str:
    """SQL: for each place of a column of bigints, the values before it merged, beginning with start.

    merge: SQL of x and y.  In blocks of the square root of the length, as an array that grows is copied at every step.
    """
    of = lambda x, y: merge.replace("x", x).replace("y", y)
    side = f"cast(ceil(sqrt(size({values}))) as int)"
    block = f"""aggregate(slice({values}, b * {side} + 1, {side}), named_struct('at', {start}, 'out', {_LONGS}),
        (i, v) -> named_struct('at', {of("i.at", "v")}, 'out', concat(i.out, array(i.at))))"""
    return f"""case when coalesce(size({values}), 0) <= 0 then {_LONGS} else aggregate(
        transform(sequence(0, (size({values}) - 1) div {side}), b -> {block}),
        named_struct('at', {start}, 'out', cast(array() as array<array<bigint>>)),
        (o, b) -> named_struct('at', {of("o.at", "b.at")}, 'out', concat(o.out, array(transform(b.out, v -> {of("o.at", "v")})))),
        o -> flatten(o.out)) end"""


def _spans_sql(kind: str, base: bool, k: int) -> str:
    """SQL for the candidates of one pattern: p, the text's pieces between its matches; m, the matches; o, their offsets."""
    kinds = "array<struct<start: bigint, end: bigint, kind: string, base: boolean, found: string, before: string, after: string>>"
    start = f"z.o{k} + length(z.p{k})"
    return f"""case when m{k} is null then cast(array() as {kinds}) else transform(slice(arrays_zip(m{k}, o{k}, p{k}), 1, size(m{k})), (z, i) -> named_struct(
        'start', {start}, 'end', {start} + length(z.m{k}), 'kind', '{kind}', 'base', {str(base).lower()},
        'found', z.m{k}, 'before', right(z.p{k}, 40), 'after', left(p{k}[i + 1], 8))) end"""


def _judged_sql(spans: str) -> str:
    """SQL: add digits, validity, votes (1, -1, 0: abstains) and features to each candidate."""
    near, against = _word(_NEAR).replace("\\", "\\\\"), _word(_AGAINST).replace("\\", "\\\\")
    digits = "regexp_replace(c.found, '[^0-9]', '')"
    domain = "lower(regexp_extract(c.found, '([A-Za-z0-9-]+)$', 1))"
    octets = "^" + r"\\.".join([_OCTET] * 4) + "$"
    valid = f"""case c.kind
        when 'email' then true
        when 'ip' then regexp_replace(c.found, '[^0-9]+', '.') rlike '{octets}'
        when 'card' then length({digits}) between 14 and 19 and {_luhn(digits)}
        else length({digits}) between 10 and 15 end"""
    gazetteer = f"""case c.kind
        when 'email' then case when array_contains(split('{_DOMAINS}', ' '), {domain}) then 1 else -1 end
        when 'ip' then case when c.found rlike '^0*(?:0|127|255)[^0-9]' then -1 else 1 end
        when 'card' then case when {digits} rlike '{_CARD_PREFIX}' then 1 else -1 end
        else case when not c.base then 0 when c.found rlike '{_PHONE_PREFIX.replace(chr(92), chr(92) * 2)}' then 1 else -1 end end"""
    context = f"case when c.before rlike '{against}' then -1 when c.before rlike '{near}' then 1 else 0 end"
    clean = "(c.before = '' or c.before rlike '[\\\\s(<\\\\[:,;]$') and (c.after = '' or c.after rlike '^[\\\\s)>\\\\].,;:!?]')"
    touching = "c.before rlike '[\\\\p{L}0-9_=\"#/.-]$' or c.after rlike '^[\\\\p{L}0-9_=\"#/-]'"
    side = lambda x, at: f"case when {x} = '' then 0 when {x} rlike '{at[0]}\\\\s{at[1]}' then 1 when {x} rlike '{at[0]}[\\\\p{{L}}0-9]{at[1]}' then 2 else 3 end"
    return f"""transform({spans}, c -> named_struct(
        'start', c.start, 'rank', array_position(array('email', 'ip', 'card', 'phone'), c.kind), 'end', c.end, 'kind', c.kind,
        'valid', c.base and ({valid}),
        'check', case when not c.base and c.kind in ('email', 'phone') then 0 when {valid} then 1 else -1 end,
        'gazetteer', {gazetteer},
        'context', {context},
        'border', case when {touching} then -1 when {clean} then 1 else 0 end,
        'form', case when not c.base then 2 when {valid} then 1 else 0 end,
        'left', {side('c.before', ('', '$'))}, 'right', {side('c.after', ('^', ''))},
        'size', least(3, length({digits}) div 5)))"""


def with_candidates(docs: DataFrame, text: Column, name: str) -> DataFrame:
    """Add a column of judged candidates, in order of start and kind."""
    own = F.struct("*")
    rows = docs.select(own.alias("row"), F.coalesce(text, F.lit("")).alias("text"))
    rows = rows.withColumn("digit", F.col("text").rlike("[0-9]")).withColumn("dotted", F.col("text").rlike("[dD][oO][tT]"))
    every = range(len(_PATTERNS))
    patterns = [pattern for _, _, pattern in _PATTERNS]
    cut = [F.when(F.expr(_NEEDS[k]), F.split("text", patterns[k], -1)).otherwise(F.array("text")).alias(f"p{k}") for k in every]
    rows = rows.select("row", "text", *cut)
    found = [F.when(F.size(f"p{k}") > 1, F.regexp_extract_all("text", F.lit(patterns[k]), F.lit(0))).alias(f"m{k}") for k in every]
    rows = rows.select("row", *[f"p{k}" for k in every], *found)
    sizes = [F.expr(f"zip_with(m{k}, slice(p{k}, 1, size(m{k})), (x, y) -> cast(length(x) + length(y) as bigint))").alias(f"l{k}") for k in every]
    rows = rows.select("*", *sizes)
    rows = rows.select("row", *[f"{c}{k}" for k in every for c in "pm"], *[F.expr(_running(f"l{k}", "x + y", "0L")).alias(f"o{k}") for k in every])
    spans = "concat(" + ", ".join(_spans_sql(kind, base, k) for k, (kind, base, _) in enumerate(_PATTERNS)) + ")"
    rows = rows.select("row", F.expr(spans).alias("c"))
    return rows.select("row.*", F.expr(f"array_sort({_judged_sql('c')})").alias(name))


FEATURES = ("kind", "form", "left", "right", "size", "context", "gazetteer", "check")


def _expectation_maximisation(counts: dict[tuple, int], rounds: int = 50) -> tuple[dict[tuple, float], dict]:
    """Dawid and Skene's model for each kind: counts of (kind, *votes) -> probability of each, and the reliabilities.

    Reliabilities are smoothed towards their start, so that a labeler which never votes keeps it.
    """
    prior = {k: 0.5 for k in KINDS}
    start = {"check": (0.95, 0.05), "gazetteer": (0.85, 0.35), "context": (0.7, 0.3), "border": (0.8, 0.35)}
    trust = {(k, v): start[v] for k in KINDS for v in LABELERS}  # chance of a yes for personal data, and for other
    chance: dict[tuple, float] = {}
    for _ in range(rounds):
        for key in counts:
            kind, votes = key[0], key[1:]
            odds = math.log(prior[kind] / (1 - prior[kind]))
            for name, vote in zip(LABELERS, votes, strict=True):
                if vote:
                    yes, no = trust[kind, name]
                    odds += math.log(yes / no) if vote > 0 else math.log((1 - yes) / (1 - no))
            chance[key] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        for kind in KINDS:
            own = [(key, n) for key, n in counts.items() if key[0] == kind]
            total = sum(n for _, n in own)
            prior[kind] = min(0.99, max(0.01, (sum(n * chance[k] for k, n in own) + 2) / (total + 4)))
            for at, name in enumerate(LABELERS, 1):
                sums = defaultdict(float)
                for key, n in own:
                    if key[at]:
                        for side, share in ((0, chance[key]), (1, 1 - chance[key])):
                            sums[side] += n * share
                            sums[side, key[at]] += n * share
                first = start[name]
                yes, no = ((sums[side, 1] + 20 * first[side]) / (sums[side] + 20) for side in (0, 1))
                trust[kind, name] = min(0.999, max(0.001, yes)), min(0.999, max(0.001, no))
    return chance, trust


def _fit_classifier(rows: list[tuple[tuple, float, float]], rounds: int = 300) -> dict[tuple, float]:
    """Logistic regression on categorical features: rows of (values, weight, probability) -> weight of each value."""
    weights: dict[tuple, float] = defaultdict(float)
    squares: dict[tuple, float] = defaultdict(lambda: 1e-8)
    total = sum(n for _, n, _ in rows) or 1.0
    for _ in range(rounds):
        gradient: dict[tuple, float] = defaultdict(float)
        for values, n, chance in rows:
            z = sum(weights[v] for v in values)
            error = n / total * (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - chance)
            for v in values:
                gradient[v] += error
        for v, g in gradient.items():
            g += 1e-4 * weights[v]
            squares[v] += g * g
            weights[v] -= 0.5 * g / math.sqrt(squares[v])
    return dict(weights)


def _values(row: tuple) -> tuple:
    """The classifier's features of a candidate: each value by itself, and the kind with its form."""
    return ("constant",), *zip(FEATURES, row, strict=True), ("kind*form", f"{row[0]}{row[1]}")


def train_span_classifier(candidates: DataFrame, name: str) -> dict[tuple, float]:
    """Weights from the column of judged candidates."""
    fields = list(dict.fromkeys((*LABELERS, *FEATURES)))
    grouped = candidates.select(F.explode(name).alias("c")).groupBy(*[F.col(f"c.{f}").alias(f) for f in fields]).count()
    rows = sorted((tuple(r[f] for f in fields), r["count"]) for r in grouped.collect())  # bounded by the values' number
    at = {f: k for k, f in enumerate(fields)}
    votes: dict[tuple, int] = defaultdict(int)
    for r, n in rows:
        votes[(r[at["kind"]], *(r[at[v]] for v in LABELERS))] += n
    # the start stands for a corpus without any candidate: one pseudo-candidate for each vote of all labelers alike
    for kind in KINDS:
        for vote in (1, -1):
            votes[(kind, *[vote] * len(LABELERS))] += 1
    chance, _ = _expectation_maximisation(votes)
    examples: dict[tuple, list[float]] = defaultdict(lambda: [0.0, 0.0])
    for r, n in rows:
        p = chance[(r[at["kind"]], *(r[at[v]] for v in LABELERS))]
        sums = examples[tuple(r[at[f]] for f in FEATURES)]
        sums[0] += n
        sums[1] += n * p
    return _fit_classifier([(_values(values), n, p / n) for values, (n, p) in sorted(examples.items())])


def _accepted_sql(weights: dict[tuple, float], c: str) -> str:
    """SQL: whether the classifier accepts the candidate c; a value never seen counts against it."""
    parts = [repr(weights.get(("constant",), -1.0))]
    for f in FEATURES:
        own = "".join(f" when {v[1]!r} then {w!r}D" for v, w in weights.items() if v[0] == f)
        parts.append(f"case {c}.{f}{own} else -2.0D end" if own else "-2.0D")
    own = "".join(f" when {v[1]!r} then {w!r}D" for v, w in weights.items() if v[0] == "kind*form")
    parts.append(f"case concat({c}.kind, {c}.form){own} else -2.0D end" if own else "-2.0D")
    return "(" + " + ".join(parts) + ") > 0"


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: id, spans (array of start, end, kind, base), in order of start and kind."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text_"))
    judged = staged(with_candidates(rows, F.col("text_"), "candidates").select("id", "candidates"), "pii-candidates")
    return _with_spans(judged, train_span_classifier(judged, "candidates")).select(F.col("id").alias(id_col), "spans")


def _with_spans(judged: DataFrame, weights: dict[tuple, float]) -> DataFrame:
    """Add spans to a written table of candidates: base matches that hold, and accepted wider ones that overlap none.

    In order of start, a base span overlaps a wider one if it begins before it and ends after its start, or begins
    later and before its end: the latest end so far and the next start tell.
    """
    far = 1 << 62
    rows = judged.select(
        "*",
        F.expr("transform(candidates, c -> case when c.valid then c.end else 0L end)").alias("ends_"),
        F.expr(f"transform(reverse(candidates), c -> case when c.valid then c.start else {far}L end)").alias("starts_"),
        F.expr("exists(candidates, c -> c.form = 2)").alias("wide_"),
    )
    rows = rows.select(
        *judged.columns,
        "wide_",
        F.expr(f"case when wide_ then {_running('ends_', 'greatest(x, y)', '0L')} end").alias("until_"),
        F.expr(f"case when wide_ then reverse({_running('starts_', 'least(x, y)', f'{far}L')}) end").alias("next_"),
    )
    wide = f"z.c.form = 2 and z.c.check >= 0 and z.until_ <= z.c.start and z.next_ >= z.c.end and {_accepted_sql(weights, 'z.c')}"
    kept = f"""case when wide_ then transform(filter(zip_with(candidates, arrays_zip(until_, next_), (c, u) -> named_struct('c', c, 'until_', u.until_, 'next_', u.next_)),
        z -> z.c.valid or ({wide})), z -> z.c) else filter(candidates, c -> c.valid) end"""
    rows = rows.select(*judged.columns, F.expr(kept).alias("kept_"))
    return rows.select(*judged.columns, F.expr("transform(kept_, c -> named_struct('start', c.start, 'end', c.end, 'kind', c.kind, 'base', c.valid))").alias("spans"))


def pii_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """From find_pii(): id, the number of base spans of each kind, base_sha256, spans as text."""
    base = "filter(spans, s -> s.base)"
    text = lambda of: f"array_join(transform({of}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')"
    counts = [F.expr(f"cast(size(filter(spans, s -> s.base and s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    return found.select(id_col, *counts, F.expr(f"sha2({text(base)}, 256)").alias("base_sha256"), F.expr(text("spans")).alias("spans"))


def redact_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents with each span replaced by its kind in angle brackets; overlapping spans go together.

    A null text stays null; texts without spans are untouched.  The search runs once: rows are written with their
    candidates, from which the classifier learns and which it then judges.
    """
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    judged = staged(with_candidates(rows, F.col(f"doc.`{text_col}`"), "candidates"), "pii-candidates")
    found = _with_spans(judged, train_span_classifier(judged.where("size(candidates) > 0"), "candidates"))
    text = f"doc.`{text_col}`"
    found = found.select("doc", "spans", F.expr("transform(spans, s -> s.end)").alias("ends_"))
    # a span that begins at or after all ends before it begins a cut, which lasts until the latest end before the next
    found = found.select("doc", "spans", "ends_", F.expr(_running("ends_", "greatest(x, y)", "0L")).alias("until_"))
    cuts = "filter(arrays_zip(spans, until_), z -> z.spans.start >= z.until_)"
    blocks = f"case when size(spans) > 0 then regexp_extract_all({text}, '(?s).{{1,{_BLOCK}}}', 0) end"
    found = found.select("doc", F.expr(cuts).alias("cuts"), F.array_max("ends_").alias("last"), F.expr(blocks).alias("blocks"), F.expr(f"cast(length({text}) as bigint)").alias("size"))
    parts = f"transform(cuts, z -> concat({_between('blocks', 'z.until_', 'z.spans.start')}, '<', upper(z.spans.kind), '>'))"
    clean = f"case when size(cuts) > 0 then concat(array_join({parts}, ''), {_between('blocks', 'last', 'size')}) else {text} end"
    found = found.select("doc", F.expr(clean).alias("clean"))
    return found.select(*[F.col("clean").alias(c) if c == text_col else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


_BLOCK = 1024


def _between(blocks: str, low: str, high: str) -> str:
    """SQL: the characters from low to high (exclusive) of a text that is given in blocks of _BLOCK characters."""
    first = f"cast({low} div {_BLOCK} as int)"
    begin = f"case when i = 0 then cast({low} % {_BLOCK} as int) else 0 end"
    end = f"cast(least({_BLOCK}, {high} - ({first} + i) * {_BLOCK}) as int)"
    part = f"substring(t, {begin} + 1, {end} - {begin})"
    return f"case when {high} <= {low} then '' else array_join(transform(slice({blocks}, {first} + 1, cast(({high} - 1) div {_BLOCK} as int) - {first} + 1), (t, i) -> {part}), '') end"
