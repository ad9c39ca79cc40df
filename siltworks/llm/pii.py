"""Personal data by weak supervision, in DataFrame functions only.

Method: base patterns (e-mail, IP address, payment card, phone) find spans that
always stay.  Looser patterns propose further candidates.  Labelers vote on
every candidate, base ones included, for (1), against (-1) or not at all (0):
the form of the string, lists of known words and prefixes (gazetteers), and
the words around it (context).  Expectation-maximisation over the counts of
vote patterns estimates each labeler's reliability and each pattern's
probability; a logistic span classifier is trained on these and decides on the
candidates.  What tells true candidates from false ones is the exact check that a
kind has by its definition (a card's check digit).  Where it votes against, a
candidate is false: it is no span, and an anchor of the estimation, so that "all
candidates are true" is no solution and labelers that vote for whatever they see
are found out.  Where it votes for, it has a given reliability, not an estimated one.  Votes and features take few values, so their counts are a table
of bounded size (``PATTERNS``), the only thing the driver sees; its sums cover
every candidate of every text.

Spans are code points, end exclusive.  Matching needs no recursion: each
pattern is rewritten so that a run of one character class is all it repeats,
which keeps very long runs safe, and places come from running sums over the
gaps between matches.  Secrets are keys with an issuer's prefix and hexadecimal
strings of 32 to 64 digits in one case.  Null counts as empty.  Equal texts get
equal spans; spans of a kind that tie in their start cannot be.  An empty table
gives an empty result.  Added columns take the place of input columns with
their names; names beginning with ``_p_`` are reserved.
"""

from __future__ import annotations

import math
from itertools import product

from pyspark.sql import Column, DataFrame, Row, functions as F

from . import scratch
from .native import let, running

BASE = ["email", "ip", "card", "phone"]
#: Kinds that only candidates have.
MORE = ["national_phone", "spelled_email", "id_number", "secret"]
KINDS = [*BASE, *MORE]

_LOCAL = "A-Za-z0-9._%+-"
_LABEL = "A-Za-z0-9-"
#: Labelers and features of candidates, in order.
LABELERS = ["form", "gazetteer", "near words", "adverse words", "check", "assignment"]
#: Labelers that are right by a kind's definition, and how far they are trusted.
EXACT = {("card", "check"): 0.995}
VOTES, FEATURES = [f"v{i}" for i in range(len(LABELERS))], ["f0", "f1", "f2"]
#: Bound of the table of counts: kinds x votes x features.
PATTERNS = len(KINDS) * 3 ** len(VOTES) * 2 ** len(FEATURES)

#: Fixed word lists of the gazetteer and context labelers.
_TLD = "com|net|org|edu|gov|info|io|de|fr|es|uk|eu|it|nl|ch|at"
_NEAR = {
    "email": "mail|contact|write|reach|correo|courriel|kontakt|schreib",
    "ip": "addr|host|server|login|client|visit",
    "card": "card|visa|master|amex|pay|tarjeta|carte|karte|credit",
    "phone": "phone|tel|call|mobile|cell|fax|ruf|appel|llam",
    "national_phone": "phone|tel|call|mobile|cell|fax|ruf|appel|llam",
    "spelled_email": "mail|contact|write|reach|correo|courriel|kontakt|schreib",
    "id_number": "ssn|social|passport|insurance|ausweis|seguridad|identi",
    "secret": "token|key|secret|passw|auth|bearer|api|credential",
}
#: How issued keys begin.
_ISSUED = "AKIA|gh[pousr]_|sk-|xox[abprs]-|glpat-"
_AGAINST = "version|release|isbn|issn|doi|sha|commit|checksum|digest|md5|build|chapter|section|page|order"


SPANS = "array<struct<s:int,e:int,m:string,b:string>>"
#: Code points before a candidate that labelers see.
BEFORE = 32


def _spans(t: Column, pattern: str) -> Column:
    """array<struct<s, e, m, b>> of a pattern's matches, from the gaps between them;
    ``b`` is what stands before, back to the match before at most."""
    matches = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))

    def place(x: Column) -> Column:
        m, gaps = x["m"], x["g"]
        sizes = F.transform(m, lambda v, i: F.length(F.get(gaps, i)) + F.length(v))

        def span(v: Column, i: Column) -> Column:
            before = F.concat(F.coalesce(F.get(m, i - 1), F.lit("")), F.get(gaps, i))
            return F.struct(F.length(v).alias("n"), v.alias("m"), F.substring(before, -BEFORE, BEFORE).alias("b"))

        made = F.zip_with(F.transform(m, span), running(sizes), lambda v, e: F.struct((e - v["n"]).cast("int").alias("s"), e.cast("int").alias("e"), v["m"].alias("m"), v["b"].alias("b")))
        return F.when(F.size(m) == 0, _none()).otherwise(made)

    return let(F.struct(matches.alias("m"), F.split(t, pattern, -1).alias("g")), place)


def _none() -> Column:
    return F.expr(f"cast(array() as {SPANS})")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def value(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return d - F.when(d > 9, 9).otherwise(0)

    return F.aggregate(F.transform(F.split(F.reverse(digits), "(?!^)(?!$)"), value), F.lit(0), lambda a, x: a + x) % 10 == 0


def _email(t: Column) -> Column:
    # Dots that do not stand between two label characters become '_', which the
    # local part takes alike and the domain does not: the domain is then one run.
    clean = F.regexp_replace(t, rf"\.(?![{_LABEL}])|(?<![{_LABEL}])\.", "_")
    pattern = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_LABEL}]++\.[{_LABEL}.]*+"
    return F.when(F.contains(t, F.lit("@")), let(clean, lambda c: _spans(c, pattern))).otherwise(_none())


def _ip(t: Column) -> Column:
    def small(m: Column) -> Column:
        return F.forall(F.split(m, r"\."), lambda p: let(F.regexp_replace(p, "^0+", ""), lambda v: (F.length(v) < 3) | ((F.length(v) == 3) & (v <= F.lit("255")))))

    found = _spans(t, r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
    return F.when(t.rlike(r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"), F.filter(found, lambda x: small(x["m"]))).otherwise(_none())


def _card_runs(t: Column) -> Column:
    # Separators that do not stand between two digits become '~': a run is then one class.
    clean = F.regexp_replace(t, r"[ -](?![0-9])|(?<![0-9])[ -]", "~")
    found = let(clean, lambda c: _spans(c, r"[0-9][0-9 -]{12,}"))
    return F.when(t.rlike(r"[0-9][0-9 -]{11,}[0-9]"), F.filter(found, lambda x: let(F.length(_digits(x["m"])), lambda n: (n >= 13) & (n <= 19)))).otherwise(_none())


def _phone(t: Column) -> Column:
    found = _spans(t, r"\+[0-9][ ().0-9-]+[0-9]")
    return F.when(t.rlike(r"\+[0-9]"), F.filter(found, lambda x: let(F.length(_digits(x["m"])), lambda n: (n >= 9) & (n <= 15)))).otherwise(_none())


def base_spans(text: str = "text") -> Column:
    """A struct with an array of spans for each base kind; ``card_runs`` also has those failing Luhn."""
    t = F.coalesce(F.col(text), F.lit(""))
    return F.struct(_email(t).alias("email"), _ip(t).alias("ip"), _card_runs(t).alias("card_runs"), _phone(t).alias("phone"))


#: Looser proposals: pattern and a cheap test that must hold first.
_PROPOSALS = {
    "national_phone": (r"(?<![0-9+])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])", r"[0-9]{3}[ .-][0-9]{4}"),
    "spelled_email": (rf"(?<![{_LOCAL}])[{_LOCAL}]++ ?[\[(]at[\])] ?[{_LABEL}]++ ?(?:\.|[\[(]dot[\])]) ?[A-Za-z]++", r"[\[(]at[\])]"),
    "id_number": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    "secret": (
        r"(?<![A-Za-z0-9])(?:(?=[a-z]*[0-9])(?=[0-9]*[a-z])[a-f0-9]{32,64}|(?=[A-Z]*[0-9])(?=[0-9]*[A-Z])[A-F0-9]{32,64}"
        r"|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64}|xox[abprs]-[A-Za-z0-9-]{10,72}|glpat-[A-Za-z0-9_-]{20})(?![A-Za-z0-9])",
        r"[a-f0-9]{32}|[A-F0-9]{32}|AKIA|gh[pousr]_|sk-|xox[abprs]-|glpat-",
    ),
}


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``base`` (struct of arrays) and ``candidates`` with votes and features."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("_p_base", base_spans(text))
    proposals = [F.when(t.rlike(test), _spans(t, pattern)).otherwise(_none()).alias(k) for k, (pattern, test) in _PROPOSALS.items()]
    out = out.withColumn("_p_more", F.struct(*proposals))

    def voted(spans: str, kind: str) -> Column:
        return F.transform(F.col(spans), lambda x: _candidate(x, kind))

    typed = [voted(f"_p_base.{k if k != 'card' else 'card_runs'}", k) for k in BASE] + [voted(f"_p_more.{k}", k) for k in MORE]
    card = F.filter(F.col("_p_base.card_runs"), lambda x: _luhn(_digits(x["m"])))
    base = F.struct(*[(card if k == "card" else F.col(f"_p_base.{k}")).alias(k) for k in BASE])
    return out.withColumn("base", base).withColumn("candidates", F.concat(*typed)).drop("_p_base", "_p_more")


def _candidate(x: Column, kind: str) -> Column:
    """kind, s, e, the votes of LABELERS and the features: quoted, long, many different characters."""
    m, digits = x["m"], _digits(x["m"])
    before = F.lower(x["b"])
    vote = lambda yes, no=F.lit(False): F.when(yes, 1).when(no, -1).otherwise(0)
    form = {
        "email": vote(m.rlike(r"^[A-Za-z0-9]") & m.rlike(r"\.[A-Za-z]{2,}$"), ~m.rlike(r"[A-Za-z]")),
        "ip": vote(m.rlike(r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$"), F.lit(True)),
        "card": vote(m.rlike(r"^(?:[0-9]{15,16}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4})$"), m.rlike("[ -]")),
        "phone": vote(m.rlike(r"^\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?[ .-]?[0-9]"), m.rlike(r"\.\.|--|  ")),
        "national_phone": vote(m.rlike(r"^\("), m.rlike(r"[.]")),
        "spelled_email": vote(m.rlike(r"[\[(]dot[\])]"), F.lit(False)),
        "id_number": vote(m.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)"), F.lit(True)),
        "secret": F.lit(0),  # a digest looks the same: only the words around tell
    }[kind]
    gazetteer = {
        "email": vote(m.rlike(rf"(?i)\.(?:{_TLD})$"), F.lit(False)),
        "spelled_email": vote(m.rlike(rf"(?i)(?:{_TLD})$"), F.lit(False)),
        "ip": vote(F.lit(False), m.rlike(r"^(?:0|127|255)\.")),
        "card": vote(digits.rlike(r"^(?:4|5[1-5]|2[2-7]|3[47]|6)"), digits.rlike(r"^(?:0|1)")),
        "phone": vote(digits.rlike(r"^(?:1|33|34|39|41|43|44|49)"), digits.rlike(r"^0")),
        "national_phone": vote(digits.rlike(r"^[2-9]"), digits.rlike(r"^[01]")),
        "secret": vote(m.rlike(rf"^(?:{_ISSUED})")),
    }.get(kind, F.lit(0))
    near = vote(before.rlike(_NEAR[kind]), F.lit(False))
    adverse = vote(F.lit(False), before.rlike(_AGAINST))
    distinct = F.size(F.array_distinct(F.split(F.lower(m), "(?!^)(?!$)")))
    check = vote(_luhn(digits), F.lit(True)) if kind == "card" else vote(F.lit(False), distinct <= 3)
    quoted = F.substring(before, -1, 1).isin('"', "'", "(", "<", "[").cast("int")
    assigned = vote(before.rlike(r"[=:] ?[\"'(<]?$"))
    votes = [v.alias(name) for v, name in zip((form, gazetteer, near, adverse, check, assigned), VOTES, strict=True)]
    features = [quoted.alias("f0"), (F.length(m) > 24).cast("int").alias("f1"), (distinct >= 10).cast("int").alias("f2")]
    return F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e"), *votes, *features)


def estimate(rows: list[Row], rounds: int = 25) -> tuple[dict[tuple, float], dict[tuple[str, int], float]]:
    """Expectation-maximisation over counts of vote patterns.

    Returns each (kind, votes) pattern's probability and the reliability of each
    labeler for each kind when it votes.  A labeler has a reliability over all
    kinds, from few pseudo-counts that say it is mostly right, and one for each
    kind, drawn towards that by ``10`` pseudo-votes.  Kinds' shares have pseudo-counts
    of two each way; the bounds only keep off 0 and 1.  A labeler is judged where
    others vote too, as a lone vote tells nothing of its own reliability, and
    candidates without a vote tell nothing of their kind's share.  Labelers in ``EXACT`` keep
    their reliability for that kind, and tell nothing of the one that they have for others;
    what they vote against is false, whatever the others say.
    """
    exact = {(kind, LABELERS.index(name)): a for (kind, name), a in EXACT.items()}
    exact_trust = max(exact.values())
    counts: dict[tuple, int] = {}
    for r in rows:
        key = (r["kind"], *(r[v] for v in VOTES))
        counts[key] = counts.get(key, 0) + r["n"]
    kinds = sorted({k[0] for k in counts})
    right = {(kind, i): exact.get((kind, i), 0.8) for kind in kinds for i in range(len(VOTES))}
    prior = dict.fromkeys(kinds, 0.5)
    post: dict[tuple, float] = {}
    bounded = lambda p: min(0.999, max(0.001, p))
    for _ in range(rounds):
        for key in counts:
            log_odds = math.log(prior[key[0]] / (1 - prior[key[0]]))
            for i, vote in enumerate(key[1:]):
                a = right[key[0], i]
                log_odds += vote * math.log(a / (1 - a))
            post[key] = 1 / (1 + math.exp(-max(-30.0, min(30.0, log_odds))))
            if any(key[1 + i] < 0 for kind, i in exact if kind == key[0]):
                post[key] = 1 - exact_trust
        for kind in kinds:
            voted = [(k, n) for k, n in counts.items() if k[0] == kind and any(k[1:])]
            prior[kind] = bounded((2 + sum(n * post[k] for k, n in voted)) / (4 + sum(n for _, n in voted)))
        for i in range(len(VOTES)):
            agreed, cast = dict.fromkeys(kinds, 0.0), dict.fromkeys(kinds, 0)
            for k, n in counts.items():
                if k[1 + i] and sum(map(abs, k[1:])) > 1 and (k[0], i) not in exact:
                    agreed[k[0]] += n * (post[k] if k[1 + i] > 0 else 1 - post[k])
                    cast[k[0]] += n
            overall = (8 + sum(agreed.values())) / (10 + sum(cast.values()))
            for kind in kinds:
                right[kind, i] = exact.get((kind, i)) or bounded((10 * overall + agreed[kind]) / (10 + cast[kind]))
    return post, right


def train(rows: list[Row], post: dict[tuple, float], steps: int = 200, rate: float = 1.0, decay: float = 1e-3) -> dict[str, float]:
    """Weights of the span classifier, fitted to the estimated probabilities.

    Features: kind, each vote as for and against, quoted, long.  Gradient
    descent on the weighted log loss over the table of counts.
    """
    names = ["bias", *KINDS, *[f"{v}{s}" for v, s in product(VOTES, "+-")], *FEATURES]
    weights = dict.fromkeys(names, 0.0)
    data = []
    for r in rows:
        on = ["bias", r["kind"], *[f"{v}{'+' if r[v] > 0 else '-'}" for v in VOTES if r[v]], *[f for f in FEATURES if r[f]]]
        data.append((on, r["n"], post[(r["kind"], *(r[v] for v in VOTES))]))
    total = sum(n for _, n, _ in data) or 1
    for _ in range(steps):
        slope = {k: decay * w for k, w in weights.items()}
        for on, n, p in data:
            z = sum(weights[k] for k in on)
            off = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - p) * n / total
            for k in on:
                slope[k] += off
        for k in names:
            weights[k] -= rate * slope[k]
    return weights


def _accepted(c: Column, weights: dict[str, float]) -> Column:
    z = F.lit(weights["bias"])
    for k in KINDS:
        z = z + F.when(c["kind"] == k, weights[k]).otherwise(0.0)
    for v in VOTES:
        z = z + F.when(c[v] > 0, weights[f"{v}+"]).when(c[v] < 0, weights[f"{v}-"]).otherwise(0.0)
    for f in FEATURES:
        z = z + F.when(c[f] > 0, weights[f]).otherwise(0.0)
    refuted = F.lit(False)
    for kind, name in EXACT:
        refuted = refuted | (c["kind"] == kind) & (c[VOTES[LABELERS.index(name)]] < 0)
    return (z >= 0) & ~refuted


def detect(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add ``base`` and ``spans``: array<struct<kind, s, e>>, base spans and accepted candidates.

    A candidate that overlaps a base span is left out.  ``carry`` names the
    input columns to keep, all by default.
    """
    names = [c for c in (docs.columns if carry is None else carry) if c not in ("base", "candidates", "spans")]
    found = scratch.table(find(docs, text).select(*names, "base", "candidates"), "pii-candidates")
    counts = found.select(F.explode("candidates").alias("c")).groupBy("c.kind", *[f"c.{v}" for v in (*VOTES, *FEATURES)]).agg(F.count("*").alias("n"))
    rows = sorted(counts.limit(PATTERNS).collect())  # the table has no more rows than PATTERNS
    post, _ = estimate(rows)
    weights = train(rows, post)
    base = base_list()

    def more(fixed: Column) -> Column:
        free = lambda c: ~F.exists(fixed, lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"]))
        chosen = F.filter("candidates", lambda c: _accepted(c, weights) & free(c))
        return F.transform(chosen, lambda c: F.struct(c["kind"].alias("kind"), c["s"].alias("s"), c["e"].alias("e")))

    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    order = lambda spans: F.transform(F.array_sort(F.transform(spans, lambda x: F.struct(rank[x["kind"]].alias("r"), x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind")))), lambda x: F.struct(x["kind"].alias("kind"), x["s"].alias("s"), x["e"].alias("e")))
    return found.withColumn("spans", let(base, lambda b: order(F.concat(b, more(b))))).drop("candidates")


def base_list() -> Column:
    """The base spans of all kinds, in their order, as array<struct<kind, s, e>>."""

    def named(kind: str) -> Column:
        return F.transform(F.col(f"base.{kind}"), lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e")))

    return F.concat(*[named(k) for k in BASE])


def joined(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")
