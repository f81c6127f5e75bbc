"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides on spans.

Fixed patterns give the base spans (e-mail, IP address, card, phone), which always count. Beyond
them, wide patterns propose candidates: credentials, local phone numbers, social security
numbers, bank accounts and titled names. Labelers (the candidate's own shape, a gazetteer of
words before it, punctuation before it, the characters around it, the mix of its characters)
vote yes, no or not at all. The votes of all candidates of all documents are counted by pattern;
expectation-maximisation over these counts estimates each labeler's reliability per answer and
each pattern's probability, and a logistic classifier over votes, kind and length is fitted to
those probabilities. Only the table of patterns, whose size is bounded by the labelers, kinds
and length classes, comes to the driver. The classifier then is one more column expression.

Everything on the data is DataFrame expressions, row by row: a document's spans need no shuffle.

Defined results: NULL and empty texts hold no span. Repeated rows get equal spans; a NULL
``doc_id`` is a row like any other. Positions count code points from 0, ends are exclusive.
A candidate that overlaps a base span, or an accepted one that begins earlier, is dropped.
Where no document holds a candidate there is no classifier, and base spans are all there is.
``redact`` leaves all columns but ``text`` as they are.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The base kinds in their order. The patterns find what the definitions of the
# kinds find, leftmost and without overlaps; possessive repeats keep Java's matcher from
# recursing, and looking behind keeps it from trying every character of a long run.
BASE_KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9]){13,}+"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"

#: Candidates: kind -> pattern. They follow the base kinds, in this order, in the span lists.
CANDIDATES = {
    "secret": r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9])[A-Za-z0-9_/+-]{16,}+={0,2}+",
    "local_phone": r"(?<![0-9+.(-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.? [A-Z][a-z]++(?: [A-Z][a-z]++)?",
}
#: Cheap necessary conditions of each pattern, tried in order on the whole text.
NEEDS = {
    "ip": ["[0-9]\\.[0-9]"],
    "card": ["[0-9]", CARD],
    "secret": ["[0-9]", "[A-Za-z0-9_/+-]{16}"],
    "local_phone": ["[0-9]{3}[ .-][0-9]{4}"],
    "ssn": ["[0-9]-[0-9]{2}-[0-9]"],
    "iban": ["[A-Z]{2}[0-9]{2}"],
}
#: Strings of which each text with a titled name holds one.
TITLES = ("Mr", "Ms", "Dr", "Prof")
#: Words whose presence shortly before a candidate speaks for its kind.
GAZETTEER = {
    "secret": "token|key|secret|password|passwd|pwd|auth|bearer|credential",
    "local_phone": "phone|tel|call|mobile|cell|fax|contact",
    "ssn": "ssn|social|security|tax",
    "iban": "iban|account|bank|konto|compte|cuenta",
    "name": "name|dear|signed|contact|patient|attn|regards",
}
#: The shape that a true span of a kind has.
SHAPES = {
    "secret": "^(?=(?:[^0-9]*[0-9]){4})(?=.*[A-Za-z])[A-Za-z0-9_/+=-]{16,256}$",
    "local_phone": r"^\(?[2-9]",
    "ssn": "^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)",
    "iban": r"^[A-Z]{2}(?!0[01])[0-9]{2}[A-Z0-9 ]{11,}$",
    "name": r"\. ?[A-Z][a-z]{2,}",
}
CONTEXT = 32
LABELERS = ("shape", "gazetteer", "punctuation", "surroundings", "mixture")
LENGTH_CLASSES = (16, 32)
ROUNDS, STEPS = 50, 400


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _needs(text: Column, kind: str) -> Column:
    if kind == "email":
        return F.contains(text, F.lit("@"))
    if kind == "phone":
        return F.contains(text, F.lit("+"))
    if kind == "name":
        return reduce(lambda a, b: a | b, (F.contains(text, F.lit(t)) for t in TITLES))
    return reduce(lambda a, b: a & b, (text.rlike(p) for p in NEEDS[kind]))


def _walk(text: Column, pattern: str, condition: Column, context: bool = False) -> Column:
    """Matches of ``pattern`` in order: array of (start, end, match, before, after).

    What stands before and after is cut to what labelers look at, and only filled on request.
    """
    kind = "array<struct<start:int,end:int,match:string,before:string,after:string>>"
    pieces = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # One piece more than matches: the last has none.
    around = F.zip_with(pieces, matches, lambda p, m: F.struct(p.alias("gap"), m.alias("match")))
    if context:
        nexts = F.transform(F.slice(pieces, 2, 1 << 30), lambda p: F.substring(p, 1, 2))
        around = F.zip_with(
            around, nexts, lambda x, n: F.struct(x["gap"].alias("gap"), x["match"].alias("match"), n.alias("after"))
        )
    state = f"struct<at:int,spans:{kind}>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("spans")).cast(state)

    def step(acc, x):
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["match"])
        span = F.struct(
            begin.alias("start"),
            end.alias("end"),
            x["match"].alias("match"),
            (F.right(x["gap"], F.lit(CONTEXT)) if context else F.lit("")).alias("before"),
            (x["after"] if context else F.lit("")).alias("after"),
        )
        grown = F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans")).cast(state)
        return F.when(x["match"].isNull(), acc).otherwise(grown)

    found = F.aggregate(around, start, step, lambda acc: acc["spans"])
    return F.when(condition, found).otherwise(F.array().cast(kind))


def _luhn(digits: Column) -> Column:
    """Whether digits, read from the right with every second one doubled, sum to a multiple of 10."""
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda acc, i: acc
        + F.when(F.pmod(F.length(digits) - i, F.lit(2)) == 0, F.substr(digits, i, F.lit(1)).cast("int")).otherwise(
            F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), F.substr(digits, i, F.lit(1)).cast("int") + 1)
        ),
    )
    return F.pmod(total, F.lit(10)) == 0


def _small_octets(match: Column) -> Column:
    value = lambda part: F.ltrim(part, F.lit("0"))
    return F.forall(
        F.split(match, r"\."),
        lambda part: F.when(F.length(value(part)) <= 3, F.concat(F.lit("0"), value(part)).cast("int") <= 255).otherwise(False),
    )


def _base(text: Column) -> dict[str, Column]:
    """Each base kind's spans, those that fail its test dropped."""
    card = lambda s: F.translate(s["match"], " -", "")
    phone = lambda s: F.length(F.translate(s["match"], "+ ().-", ""))
    return {
        "email": _walk(text, EMAIL, _needs(text, "email")),
        "ip": F.filter(_walk(text, IP, _needs(text, "ip")), lambda s: _small_octets(s["match"])),
        "card": F.filter(
            _walk(text, CARD, _needs(text, "card")),
            lambda s: F.when(F.length(card(s)).between(14, 19), _luhn(card(s))).otherwise(False),
        ),
        "phone": F.filter(_walk(text, PHONE, _needs(text, "phone")), lambda s: phone(s).between(10, 15)),
    }


def _votes(kind: str, s: Column) -> list[Column]:
    """1, 0 or NULL of each labeler for a candidate of this kind."""
    match, before, after = s["match"], s["before"], s["after"]
    near = F.lower(before)
    letters = F.regexp_replace(match, "[^A-Za-z]", "")
    words = "^[A-Z]?[a-z]+(?:[-_/+][A-Z]?[a-z]+)*[0-9]?$"
    return [
        F.when(match.rlike(SHAPES[kind]), 1).otherwise(0),
        F.when(near.rlike(f"(?:{GAZETTEER[kind]})[^a-z]*$"), 1)
        .when(near.rlike(GAZETTEER[kind]), F.lit(None).cast("int"))
        .otherwise(0),
        F.when(before.rlike("[=:]\\s*[\"']?$"), 1).otherwise(F.lit(None).cast("int")),
        F.when(before.rlike("[/|#\\\\]$") | after.rlike("^[/|@\\\\]"), 0)
        .when(before.rlike("(?:^|[\\s\"'(=:])$") & after.rlike("^(?:$|[\\s\"'),.;])"), 1)
        .otherwise(F.lit(None).cast("int")),
        F.when(match.rlike(words), 0)
        .when(F.length(letters).between(1, F.length(match) - 3), 1)
        .otherwise(F.lit(None).cast("int")),
    ]


def _candidates(text: Column) -> Column:
    """All candidates: array of (start, end, kind, votes, size class)."""
    def of(kind: str) -> Column:
        return F.transform(
            _walk(text, CANDIDATES[kind], _needs(text, kind), context=True),
            lambda s: F.struct(
                s["start"].alias("start"),
                s["end"].alias("end"),
                F.lit(kind).alias("kind"),
                F.concat(*(F.coalesce(v.cast("string"), F.lit("-")) for v in _votes(kind, s))).alias("votes"),
                sum(((F.length(s["match"]) > n).cast("int") for n in LENGTH_CLASSES), F.lit(0)).alias("long"),
            ),
        )

    return F.concat(*map(of, CANDIDATES))


def vote_patterns(docs: DataFrame) -> DataFrame:
    """(kind, votes, long, n): how often candidates of all documents got which votes.

    Candidates that overlap a base span have no vote. Each step uses what the one before made
    more than once, so that Spark computes it once and not once for every use.
    """
    empty = F.array().cast("array<struct<start:int,end:int>>")
    step = docs.select(_candidates(_text()).alias("found"), _text().alias("text"))
    base = F.concat(
        *(
            F.transform(x, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
            for x in _base(F.col("text")).values()
        )
    )
    step = step.select("found", F.when(F.size("found") > 0, base).otherwise(empty).alias("taken"))
    apart = F.filter(
        "found", lambda c: ~F.exists("taken", lambda s: (c["start"] < s["end"]) & (s["start"] < c["end"]))
    )
    apart = F.when(F.size("taken") == 0, F.col("found")).otherwise(apart)
    return (
        step.select(F.explode_outer(apart).alias("c"))
        .filter("c.kind is not null")
        .groupBy("c.kind", "c.votes", "c.long")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def train_span_classifier(docs: DataFrame) -> dict | None:
    """Weights of the span classifier, from the votes over all of ``docs``; None without candidates.

    At most kinds * 3 ** labelers * length classes rows come to the driver.
    """
    patterns = sorted((r["kind"], r["votes"], r["long"], r["n"]) for r in vote_patterns(docs).collect())
    if not patterns:
        return None
    chances = _expectation_maximisation(patterns)
    return _logistic(patterns, chances)


def _expectation_maximisation(patterns) -> list[float]:
    """Each pattern's probability of personal data, and with it each labeler's reliability.

    Starts from labelers that are right eight times of ten; sums start at that belief, worth
    ten candidates, so that a labeler that hardly votes stays useful.
    """
    right = [[0.8, 0.8] for _ in LABELERS]  # P(vote 0 | not personal), P(vote 1 | personal)
    prior = {kind: 0.5 for kind, *_ in patterns}
    chances: list[float] = []
    for _ in range(ROUNDS):
        chances = []
        for kind, votes, _, _ in patterns:
            odds = math.log(prior[kind] / (1 - prior[kind]))
            for (no, yes), vote in zip(right, votes, strict=True):
                if vote == "1":
                    odds += math.log(yes / (1 - no))
                elif vote == "0":
                    odds += math.log((1 - yes) / no)
            chances.append(1 / (1 + math.exp(-max(min(odds, 30), -30))))
        for k in range(len(LABELERS)):
            agree, total = [8.0, 8.0], [10.0, 10.0]
            for (_, votes, _, n), chance in zip(patterns, chances, strict=True):
                if votes[k] != "-":
                    total[0] += n * (1 - chance)
                    total[1] += n * chance
                    agree[0] += n * (1 - chance) * (votes[k] == "0")
                    agree[1] += n * chance * (votes[k] == "1")
            # A labeler is never believed to be worse than chance, nor infallible.
            right[k] = [min(max(a / t, 0.55), 0.98) for a, t in zip(agree, total, strict=True)]
        for kind in prior:
            own = [(n, c) for (k, _, _, n), c in zip(patterns, chances, strict=True) if k == kind]
            prior[kind] = min(max((1 + sum(n * c for n, c in own)) / (2 + sum(n for n, _ in own)), 0.05), 0.95)
    return chances


def _features(kind: str, votes: str, long: int) -> list[str]:
    return ["bias", f"kind {kind}", f"long {long}", *(f"{k} {v}" for k, v in enumerate(votes) if v != "-")]


def _logistic(patterns, chances) -> dict[str, float]:
    """Logistic regression on the patterns' features, each pattern weighing the log of its count."""
    weights: dict[str, float] = {}
    rows = [(_features(k, v, s), c, math.log1p(n)) for (k, v, s, n), c in zip(patterns, chances, strict=True)]
    total = sum(w for *_, w in rows)
    for _ in range(STEPS):
        slope: dict[str, float] = {}
        for names, chance, weight in rows:
            score = sum(weights.get(x, 0.0) for x in names)
            error = (1 / (1 + math.exp(-max(min(score, 30), -30))) - chance) * weight / total
            for x in names:
                slope[x] = slope.get(x, 0.0) + error
        for x, value in slope.items():
            weights[x] = weights.get(x, 0.0) * (1 - 1e-4) - 4.0 * value
    return weights


def _accepted(candidates: Column, weights: dict[str, float]) -> Column:
    """Candidates that the classifier holds for personal data with a probability of one half or more."""

    def score(c: Column) -> Column:
        terms = [F.lit(weights.get("bias", 0.0))]
        for name, weight in sorted(weights.items()):
            head, _, tail = name.partition(" ")
            if head == "kind":
                hit = c["kind"] == tail
            elif head == "long":
                hit = c["long"] == int(tail)
            elif head == "bias":
                continue
            else:
                hit = F.substring(c["votes"], int(head) + 1, 1) == tail
            terms.append(F.when(hit, F.lit(weight)).otherwise(0.0))
        return reduce(lambda a, b: a + b, terms)

    return F.filter(candidates, lambda c: score(c) >= 0)


def with_spans(docs: DataFrame, weights: dict | None) -> DataFrame:
    """``docs`` with a struct column ``pii``: the base spans by kind, and all spans in order.

    ``pii.spans`` is an array of (start, rank, end, kind), rank being the kind's place.
    """
    kinds = [*BASE_KINDS, *CANDIDATES]
    shape = "array<struct<start:int,rank:int,end:int,kind:string>>"

    def ranked(spans: Column, kind: str) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(kinds.index(kind)).alias("rank"),
                s["end"].alias("end"), F.lit(kind).alias("kind"),
            ),
        ).cast(shape)

    base = _base(_text())
    step = docs.withColumn("__base", F.struct(*(ranked(v, k).alias(k) for k, v in base.items())))
    all_base = F.concat(*(F.col(f"__base.{k}") for k in BASE_KINDS))
    if weights is None:
        more = F.array().cast(shape)
    else:
        step = step.withColumn("__found", _accepted(_candidates(_text()), weights))
        found = F.col("__found")
        free = F.filter(
            found,
            lambda c: ~F.exists(all_base, lambda s: (c["start"] < s["end"]) & (s["start"] < c["end"]))
            & ~F.exists(
                found,
                lambda s: (c["start"] < s["end"]) & (s["start"] < c["end"])
                & ((s["start"] < c["start"]) | ((s["start"] == c["start"]) & (s["end"] > c["end"]))),
            ),
        )
        places = F.array(*map(F.lit, kinds))
        more = F.transform(
            free,
            lambda s: F.struct(
                s["start"].alias("start"), (F.array_position(places, s["kind"]) - 1).cast("int").alias("rank"),
                s["end"].alias("end"), s["kind"].alias("kind"),
            ),
        ).cast(shape)
    pii = F.struct(
        F.col("__base").alias("base"),
        F.array_sort(all_base).alias("base_spans"),
        F.array_sort(F.concat(all_base, more)).alias("spans"),
    )
    return step.withColumn("pii", pii).drop("__base", "__found")


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redact(docs: DataFrame, weights: dict | None) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; NULL texts stay NULL.

    Overlapping spans are replaced together, under the kind of the first.
    """
    names = docs.columns
    plain = docs.select(*(F.col(f"`{n}`").alias(f"c{k}") for k, n in enumerate(names)))
    text = F.col(f"c{names.index('text')}")
    found = with_spans(plain.withColumn("text", text), weights)
    state = "struct<at:int,parts:array<string>>"

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        cut = F.substr(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        parts = F.when(fresh, F.concat(acc["parts"], F.array(cut, F.concat(F.lit("<"), F.upper(s["kind"]), F.lit(">"))))).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), parts.alias("parts")).cast(state)

    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts")).cast(state)
    replaced = F.aggregate(
        F.col("pii.spans"),
        empty,
        step,
        lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substr(F.col("text"), acc["at"] + 1, F.length("text"))),
    )
    new = F.when(F.col("text").isNull() | (F.size("pii.spans") == 0), F.col("text")).otherwise(replaced)
    return found.select(
        *(new.alias(n) if n == "text" else F.col(f"c{k}").alias(n) for k, n in enumerate(names))
    )


def personal_data(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans) for each row of ``docs``."""
    texts = docs.select("doc_id", "text")
    found = with_spans(texts, train_span_classifier(texts))
    return found.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        *(F.size(f"pii.base.{k}").cast("long").alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(spans_text(F.col("pii.base_spans")), 256).alias("base_sha256"),
        spans_text(F.col("pii.spans")).alias("spans"),
        F.size("pii.spans").cast("long").alias("n_spans"),
    )


