"""Personal data by weak supervision (DataFrame functions only on executors).

Candidates are spans of the base kinds (e-mail, IP address, card, phone) and of
looser ones: long numbers, phone numbers without a plus sign, titled names.
Five labelers vote on each for (1), against (-1) or abstain (0): the regex of its
kind's valid form, its edges, a gazetteer (top-level domains, reserved networks,
issuer prefixes, country codes, given names), and cue words before it that speak
for or against.  Expectation-maximisation over the counts of all vote patterns
estimates how reliable each labeler is and how often a kind is personal data;
the posteriors then train a logistic classifier on votes and kind, which decides
on the looser candidates.  Spans of the base kinds always stay; a further span
is added only where it overlaps none of them.

Candidates stay in their document's row.  The driver sees the counts of vote
patterns, at most kinds x 3^5 rows whatever the input.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import let
from quire.llm import rows
from quire.session import materialize

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("long_number", "local_phone", "name")

# Possessive forms of the kinds' patterns: they find the same matches in one pass.
# An e-mail starts where a run of its characters does or where the last one ended.
_MAIL = r"A-Za-z0-9._%+-"
_TITLES = "Mr|Mrs|Ms|Miss|Dr|Prof|Sir|Herr|Frau|Monsieur|Madame|Mme|Señor|Señora|Sra|Don|Doña"
_CAPITAL = r"\p{Lu}\p{Ll}++"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_MAIL}]))[{_MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "long_number": r"(?<![0-9])[0-9]{13,19}+(?![0-9])",
    "local_phone": r"(?<![0-9A-Za-z+(./-])(?:\([0-9]{2,5}\)\x20?|[0-9]{2,5}[\x20/-])[0-9]{2,5}(?:[\x20-][0-9]{2,5}){1,3}+(?![0-9A-Za-z])",
    "name": rf"(?<![\p{{L}}0-9])(?:{_TITLES})\.?\x20{_CAPITAL}(?:[\x20-]{_CAPITAL}){{0,2}}",
}
#: What a text must hold for a kind to be looked for at all.
_HINTS = {"email": "@", "phone": "+"}

# Gazetteers and cue words.
_TLDS = "com|org|net|edu|gov|info|io|de|fr|es|it|uk|us|eu|ch|at|nl|be|pl|ca|au|jp|in|br|mx"
_RESERVED = r"^(?:0|10|127|169\.254|192\.168|22[4-9]|2[3-5][0-9])\."
_ISSUERS = r"^(?:3[0-9]|4|5[1-5]|2[2-7]|6)"
_COUNTRIES = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
_GIVEN = "Anna|Maria|John|James|Mary|Peter|Paul|Thomas|Michael|Hans|Karl|Marie|Jean|Pierre|Luis|Jose|Carlos|Ana|Laura|David|Sarah|Emma|Julia|Martin"
_FOR = {
    "email": "mail|contact|contacto|kontakt|write to|courriel|correo",
    "ip": r"\bip\b|address|host|server|client|adresse|login|logged",
    "card": "card|visa|master|credit|debit|karte|carte|tarjeta|payment|account",
    "long_number": "card|visa|master|credit|debit|karte|carte|tarjeta|payment|account",
    "phone": "phone|tel|call|mobile|fax|cell|anruf|appel|llam|handy",
    "local_phone": "phone|tel|call|mobile|fax|cell|anruf|appel|llam|handy",
    "name": "name|dear|signed|contact|regards|called|nom|nombre|heißt",
}
_AGAINST = r"version|licen[sc]e|isbn|issn|doi|chapter|section|figure|table|page|order|item|article|serial|hash|sha|copyright|\bno\.|\bid\b"
_CONTEXT = 40
LABELERS = ("form", "edges", "gazetteer", "cue_for", "cue_against")
ROUNDS = 60


def _luhn(digits: Column) -> Column:
    """Whether a string of digits has a valid check digit."""
    n = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))

    total = F.aggregate(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), F.lit(0), lambda a, i: a + worth(i))
    return (n > 0) & (total % 10 == 0)


def _valid(kind: str, found: Column) -> Column:
    """The checks of the base kinds, and forms of the looser ones."""
    if kind == "email" or kind == "name":
        return F.lit(True)
    if kind == "ip":
        part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return found.rlike(rf"^{part}(?:\.{part}){{3}}\z")
    digits = F.regexp_replace(found, "[^0-9]", "")
    n = F.length(digits)
    if kind == "phone":
        return n.between(9, 15)
    if kind == "local_phone":
        return n.between(9, 12)
    return F.when(n.between(13, 19), _luhn(digits)).otherwise(False)


def _vote(yes: Column, no: Column | bool) -> Column:
    against = no if isinstance(no, Column) else F.lit(no)
    return F.when(yes, 1).when(against, -1).otherwise(0).cast("int")


def _votes(kind: str, c: Column, valid: Column) -> dict[str, Column]:
    found, near = c["found"], F.lower(F.right(c["before"], F.lit(_CONTEXT)))
    touches = F.right(c["before"], F.lit(1)).rlike(r"[\p{L}\p{N}]") | F.left(c["after"], F.lit(1)).rlike(r"[\p{L}\p{N}]")
    listed = {
        "email": lambda: _vote(found.rlike(rf"(?i)\.(?:{_TLDS})\z"), False),
        "ip": lambda: _vote(~found.rlike(_RESERVED), True),
        "card": lambda: _vote(found.rlike(_ISSUERS), True),
        "long_number": lambda: _vote(found.rlike(_ISSUERS), True),
        "phone": lambda: _vote(found.rlike(_COUNTRIES), False),
        "local_phone": lambda: _vote(found.rlike(r"^\(?0"), False),
        "name": lambda: _vote(found.rlike(rf"\b(?:{_GIVEN})\b"), False),
    }
    return {
        "form": _vote(valid, True),
        "edges": _vote(~touches, True),
        "gazetteer": listed[kind](),
        "cue_for": _vote(near.rlike(_FOR[kind]), False),
        "cue_against": _vote(F.lit(False), near.rlike(_AGAINST)),
    }


def candidates(text: Column) -> Column:
    """``array<struct<kind, start, end, valid, form, edges, ...>>`` of a text."""

    def of(kind: str, t: Column) -> Column:
        def judged(c: Column) -> Column:
            return let(
                _valid(kind, c["found"]),
                lambda ok: F.struct(
                    F.lit(KINDS.index(kind)).alias("kind"), c["start"].alias("start"), c["end"].alias("end"), ok.alias("valid"), *(v.alias(n) for n, v in _votes(kind, c, ok).items())
                ),
            )

        return F.transform(rows.matches(t, PATTERNS[kind]), judged)

    none = "array<struct<kind:int,start:int,end:int,valid:boolean," + ",".join(f"{n}:int" for n in LABELERS) + ">>"

    def all_kinds(t: Column) -> Column:
        found = []
        for kind in KINDS:
            hint = t.contains(_HINTS[kind]) if kind in _HINTS else t.rlike(_TITLES) if kind == "name" else t.rlike("[0-9]")
            found.append(F.when(hint, of(kind, t)).otherwise(F.array().cast(none)))
        return F.concat(*found)

    return let(text, all_kinds)


# --- the label model and the classifier, over counts of vote patterns ---------


def reliabilities(patterns: dict[tuple[int, ...], int], rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """Posterior of each (kind, votes...) pattern by expectation-maximisation:
    labelers err independently, each with its own rates; priors are by kind."""
    posterior = {p: 0.5 + 0.4 * ((s := sum(p[1:])) > 0) - 0.4 * (s < 0) for p in patterns}
    for _ in range(rounds):
        prior = {k: [1.0, 1.0] for k in range(len(KINDS))}
        rate = [[{v: 1.0 for v in (-1, 0, 1)} for _ in LABELERS] for _ in (0, 1)]
        for p, n in patterns.items():
            for y, w in enumerate((1 - posterior[p], posterior[p])):
                prior[p[0]][y] += n * w
                for j, v in enumerate(p[1:]):
                    rate[y][j][v] += n * w
        for p in patterns:
            log = [math.log(prior[p[0]][y]) + sum(math.log(rate[y][j][v] / sum(rate[y][j].values())) for j, v in enumerate(p[1:])) for y in (0, 1)]
            posterior[p] = 1 / (1 + math.exp(max(-500.0, min(500.0, log[0] - log[1]))))
    return posterior


def _inputs(p: tuple[int, ...]) -> list[float]:
    return [1.0, *(float(p[0] == k) for k in range(1, len(KINDS))), *(float(v == s) for v in p[1:] for s in (1, -1))]


def train(patterns: dict[tuple[int, ...], int], posterior: dict[tuple[int, ...], float], steps: int = 400, decay: float = 1e-3) -> list[float]:
    """Weights of a logistic classifier of ``_inputs``, fitted to the posteriors
    by gradient descent over the patterns, each weighted by its count."""
    total = sum(patterns.values())
    rows_ = [(_inputs(p), n / total, posterior[p]) for p, n in sorted(patterns.items())]
    weights = [0.0] * len(_inputs((0,) * (1 + len(LABELERS))))
    for _ in range(steps):
        slope = [decay * w for w in weights]
        for x, n, y in rows_:
            error = n * (1 / (1 + math.exp(-max(-500.0, min(500.0, sum(a * b for a, b in zip(x, weights)))))) - y)
            for i, a in enumerate(x):
                if a:
                    slope[i] += error
        weights = [w - 2.0 * s for w, s in zip(weights, slope)]
    return weights


def _accepted(c: Column, weights: list[float]) -> Column:
    """Whether the classifier takes a candidate for personal data."""
    kinds, votes = weights[1 : len(KINDS)], weights[len(KINDS) :]
    parts = [F.when(c["kind"] == k + 1, w).otherwise(0.0) for k, w in enumerate(kinds)]
    parts += [F.when(c[n] == 1, votes[2 * j]).when(c[n] == -1, votes[2 * j + 1]).otherwise(0.0) for j, n in enumerate(LABELERS)]
    return reduce(lambda x, y: x + y, parts, F.lit(weights[0])) >= 0


def _clear_of(spans: Column, others: Column) -> Column:
    """Those of ``spans`` that overlap none of ``others``, by start: both are put
    in order of start, and each span is compared with the furthest end among the
    others before it and the nearest start among those after it."""
    item = lambda mine: lambda s: F.struct(s["start"].alias("start"), F.lit(mine).alias("mine"), s["end"].alias("end"), s.alias("span"))

    def judged(all_: Column) -> Column:
        ends = rows.most_before(F.transform(all_, lambda s: F.when(s["mine"], -1).otherwise(s["end"])))
        # from the back, starts count down from the last one's
        final = F.get(all_, F.size(all_) - 1)["start"]
        starts = F.reverse(rows.most_before(F.reverse(F.transform(all_, lambda s: F.when(s["mine"], -1).otherwise(final - s["start"])))))

        met = F.zip_with(ends, starts, lambda e, n: F.struct(e.alias("end"), n.alias("start")))

        def alone(c: Column) -> Column:
            s, others_ = c["s"], c["others"]
            return s["mine"] & (others_["end"] <= s["start"]) & ((others_["start"] < 0) | (final - others_["start"] >= s["end"]))

        return let(F.zip_with(all_, met, lambda s, o: F.struct(s.alias("s"), o.alias("others"))), lambda z: F.transform(F.filter(z, alone), lambda c: c["s"]["span"]))

    both = F.array_sort(F.concat(F.transform(spans, item(True)), F.transform(others, item(False))))
    return F.when((F.size(spans) > 0) & (F.size(others) > 0), let(both, judged)).otherwise(spans)


def _spans(found: Column, weights: list[float] | None) -> Column:
    base = F.filter(found, lambda c: (c["kind"] < len(BASE_KINDS)) & c["valid"])
    if weights is None:
        return base
    loose = F.filter(found, lambda c: (c["kind"] >= len(BASE_KINDS)) & _accepted(c, weights))

    def added(b: Column, all_: Column) -> Column:
        # of looser spans that overlap, the kind listed first stays
        clear = [_clear_of(F.filter(all_, lambda c: c["kind"] == k), F.concat(b, F.filter(all_, lambda c: c["kind"] < k))) for k in range(len(BASE_KINDS), len(KINDS))]
        return F.when(F.size(all_) > 0, F.concat(b, *clear)).otherwise(b)

    return let(base, lambda b: let(loose, lambda all_: added(b, all_)))


def find(docs: DataFrame, text: Column, keep: dict[str, Column]) -> DataFrame:
    """One row per row of ``docs``: the columns of ``keep`` and ``spans``,
    ``array<struct<kind, start, end>>`` by kind as listed in ``KINDS``, then
    start; positions in code points, end exclusive.

    Null text counts as empty and has no spans.  Repeated rows get equal spans.
    Without any candidate there is no classifier and no span.  An empty table
    gives no rows.  ``keep`` must not use the name ``spans``.
    """
    found = docs.select(F.struct(*(c.alias(n) for n, c in keep.items())).alias("row"), candidates(F.coalesce(text, F.lit(""))).alias("found"))
    found = materialize(found, "candidates")
    each = found.select(F.explode("found").alias("c")).groupBy("c.kind", *(f"c.{n}" for n in LABELERS)).count()
    patterns = {tuple(r)[:-1]: r[-1] for r in each.collect()}
    weights = train(patterns, reliabilities(patterns)) if patterns else None
    names = F.array(*(F.lit(k) for k in KINDS))
    spans = F.transform(_spans(F.col("found"), weights), lambda c: F.struct(F.get(names, c["kind"]).alias("kind"), c["start"].alias("start"), c["end"].alias("end")))
    return found.select("row", spans.alias("spans")).select(*(F.col("row")[n].alias(n) for n in keep), "spans")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span (or chain of spans that overlap) replaced by its
    kind in capitals and brackets, the kind of the first of a chain."""
    by_start = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])))

    def chains(ordered: Column) -> Column:
        """The first span of each chain, with the end of the chain before it."""
        reached = rows.most_before(F.transform(ordered, lambda s: s["end"]))
        each = F.zip_with(ordered, reached, lambda s, e: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), e.alias("before")))
        return F.filter(each, lambda c: c["start"] >= c["before"])

    def rebuilt(ordered: Column, heads: Column, parts: Column) -> Column:
        before = F.transform(heads, lambda h: F.concat(rows.between(parts, F.greatest(h["before"], F.lit(0)), h["start"]), F.lit("["), F.upper(h["kind"]), F.lit("]")))
        last = F.array_max(F.transform(ordered, lambda s: s["end"]))
        return F.concat(F.array_join(before, ""), rows.between(parts, last, F.length(text)))

    whole = let(by_start, lambda o: let(chains(o), lambda h: let(rows.chunks(text), lambda p: rebuilt(o, h, p))))
    return F.when(F.size(spans) > 0, whole).otherwise(text)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in the text replaced; null text stays null."""
    held = {f"c{i}": F.col(c) for i, c in enumerate(docs.columns)}
    found = find(docs, F.col(text_col), held)
    return found.select(*((redacted(F.col(k), F.col("spans")) if c == text_col else F.col(k)).alias(c) for k, c in zip(held, docs.columns)))
