"""Personal data by weak supervision, in DataFrame functions only.

Spans of the strict patterns always count. Looser patterns propose further
spans; labelers (pattern, validity, gazetteer, context, boundary) vote on every
span, expectation-maximisation over the counts of vote patterns estimates how
reliable each labeler is, and a logistic span classifier trained on the
resulting beliefs decides about the proposed ones.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kelvane.functions.once import computed_once
from kelvane.llm.common import picked, saved

KINDS = ("email", "ip", "card", "phone", "secret")
LABELERS = ("pattern", "valid", "gazetteer", "context", "edge")
MARK = "\x01"
_LOCAL = "[A-Za-z0-9._%+-]"

# Runs are possessive and start at their first character, so that a long run is
# read once; the matches are those of the plain patterns.
STRICT = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?i)(?<!{_LOCAL}){_LOCAL}++\x20?[\[({{]at[\])}}]\x20?[a-z0-9-]++"
             r"(?:(?:\.|\x20?[\[({]dot[\])}]\x20?)[a-z0-9-]++)++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,14}+(?![0-9])",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9])",
    "secret": r"(?i)(?<![a-z0-9])(?:password|passwd|pwd|token|secret|api[_-]?key)\x20{0,3}[:=]\x20{0,3}"
              r"[\x22']?[a-z0-9+/_-]{12,}[\x22']?",
}
# A text without this cannot match.
HINT = {
    "email": r"@|(?i)[\[({]at[\])}]", "ip": r"[0-9]\.[0-9]", "card": "[0-9]", "phone": "[0-9]",
    "secret": "[:=]",
}
TOP_LEVELS = ("com", "org", "net", "edu", "gov", "int", "info", "io", "de", "fr", "es", "uk", "eu", "it", "nl")
CONTEXT = {
    "email": "mail|contact|write|reach|address",
    "ip": r"\bip\b|address|host|server|login",
    "card": "card|visa|credit|payment|amex",
    "phone": r"\btel\b|phone|call|mobile|fax|contact|\bcell\b",
    "secret": r"[:=]",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
SPAN = "array<struct<s:int,e:int,t:string>>"


def _matches(text: Column, pattern: str, hint: str) -> Column:
    """Leftmost non-overlapping matches with their places in code points.

    Matches are set between marks and the text is split there, so every second
    part is a match; lengths of the parts give the places.
    """
    marked = F.regexp_replace(text, pattern, f"{MARK}$0{MARK}")
    none = F.array().cast(SPAN)
    start = F.struct(F.lit(0).alias("pos"), F.lit(False).alias("hit"), none.alias("found"))

    def add(a: Column, part: Column) -> Column:
        end = a["pos"] + F.length(part)
        span = F.struct(a["pos"].alias("s"), end.alias("e"), part.alias("t"))
        return F.struct(end.alias("pos"), (~a["hit"]).alias("hit"),
                        F.when(a["hit"], F.concat(a["found"], F.array(span))).otherwise(a["found"]).alias("found"))

    found = F.aggregate(F.split(marked, MARK, -1), start, add, lambda a: a["found"])
    return F.when(text.rlike(hint), found).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the checksum of a digit string is right."""
    places = F.sequence(F.lit(1), F.length(digits))

    def worth(i: Column) -> Column:
        digit = F.substring(digits, F.length(digits) + 1 - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, digit).otherwise(F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2))

    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, x: a + x) % 10 == 0


def _strict(kind: str, value: Column) -> Column:
    """The further condition on a strict match; a failing one is dropped."""
    digits = _digits(value)
    return {
        "email": lambda: F.lit(True),
        "ip": lambda: value.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"),
        "card": lambda: F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False),
        "phone": lambda: F.length(digits).between(8, 15),
    }[kind]()


def _votes(kind: str, text: Column, span: Column, strict: bool) -> dict[str, Column]:
    """Each labeler's vote on a span: 1 personal, 0 not, -1 abstains."""
    value, digits = span["t"], _digits(span["t"])
    vote = lambda c: F.when(c, 1).otherwise(0)
    before = F.substring(text, F.greatest(span["s"] - 39, F.lit(1)), F.least(span["s"], F.lit(40)))
    around = F.concat(F.substring(text, span["s"], F.when(span["s"] > 0, 1).otherwise(0)),
                      F.substring(text, span["e"] + 1, F.lit(1)))
    tail = F.lower(F.regexp_extract(value, "([A-Za-z]+)[^A-Za-z]*$", 1))
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]")
    pattern = F.lit(1) if strict else {
        "email": F.lit(-1), "card": F.lit(0), "phone": F.lit(1),
        "secret": vote(value.rlike(r"[0-9A-Fa-f]{16,}")),
    }[kind]
    valid = {
        "email": lambda: vote(F.length(tail) >= 2), "ip": lambda: F.lit(1),
        "card": lambda: F.lit(1) if strict else vote(_luhn(digits)),
        "phone": lambda: vote(F.length(digits).between(8, 15)), "secret": lambda: vote(mixed),
    }[kind]()
    gazetteer = {
        "email": vote(tail.isin(*TOP_LEVELS)),
        "ip": vote(~value.rlike(r"^0*(?:0|127|255)\.")),
        "card": vote(digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6)")),
        "phone": F.when(F.length(digits) == 10, vote(~digits.rlike("^[01]"))).otherwise(
            vote(digits.rlike("^[1-9]"))),
        "secret": vote(value.rlike("(?i)pass|token|secret|key")),
    }[kind]
    context = F.lit(1) if kind == "secret" else F.when(
        before.rlike(f"(?i)(?:{CONTEXT[kind]})"), 1).otherwise(-1)
    edge = vote(~around.rlike("[A-Za-z0-9]"))
    return dict(zip(LABELERS, (pattern, valid, gazetteer, context, edge)))


def _voted(kind: str, text: Column, spans: Column, strict: bool) -> Column:
    return F.transform(spans, lambda x: F.struct(
        F.lit(KINDS.index(kind)).alias("k"), x["s"].alias("s"), x["e"].alias("e"), F.lit(strict).alias("base"),
        *[v.cast("int").alias(name) for name, v in _votes(kind, text, x, strict).items()],
        F.least(F.floor((x["e"] - x["s"]) / 8), F.lit(3)).cast("int").alias("size")))


def candidates(rows: DataFrame, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and ``spans``: the strict spans of the column ``text``
    and the proposed ones clear of them, with their votes."""
    rows = rows.select(*keep, F.translate(F.coalesce("text", F.lit("")), MARK, "\x02").alias("text"))
    text = F.col("text")
    meets = lambda kind: lambda x: _strict(kind, x["t"])
    found = {f"strict_{k}": F.filter(_matches(text, p, HINT[k]), meets(k)) for k, p in STRICT.items()}
    found |= {f"loose_{k}": _matches(text, p, HINT[k]) for k, p in LOOSE.items()}
    rows = computed_once(rows, [*keep, "text"], **found)
    rows = rows.withColumn("strict", F.concat(*[F.col(f"strict_{k}") for k in STRICT]))
    clear = {k: F.filter(f"loose_{k}", lambda x: ~F.exists(
        "strict", lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))) for k in LOOSE}
    return rows.select(*keep, F.concat(
        *[_voted(k, text, F.col(f"strict_{k}"), True) for k in STRICT],
        *[_voted(k, text, spans, False) for k, spans in clear.items()]).alias("spans"))


@dataclass(frozen=True)
class Judgement:
    """What the labelers are worth and the weights of the span classifier."""

    reliability: dict[str, tuple[float, float]]  # share of votes 1 on not personal, on personal spans
    prior: dict[str, float]
    weights: dict[str, float]

    def log_odds(self, span: Column) -> Column:
        total = F.lit(self.weights["bias"])
        for name, weight in self.weights.items():
            if name == "bias" or not weight:
                continue
            feature, _, wanted = name.partition("=")
            total = total + F.when(span[feature] == int(wanted), weight).otherwise(0.0)
        return total


def _features(row: dict) -> list[str]:
    return ["bias", *[f"{n}={row[n]}" for n in LABELERS if row[n] >= 0], f"k={row['k']}", f"size={row['size']}"]


def learn(patterns: list[dict], rounds: int = 40, steps: int = 300) -> Judgement:
    """Reliabilities and classifier from the counts of vote patterns.

    ``patterns`` has a row for each kind, vote pattern and size class that occurs:
    at most 5 x 3^5 x 4, however many spans there are.
    """
    rate = {name: [0.3, 0.9] for name in LABELERS}
    prior = dict.fromkeys(range(len(KINDS)), 0.7)
    belief = [0.5] * len(patterns)
    for _ in range(rounds):
        for i, row in enumerate(patterns):
            odds = math.log(prior[row["k"]] / (1 - prior[row["k"]]))
            for name in LABELERS:
                no, yes = rate[name]
                if row[name] == 1:
                    odds += math.log(yes / no)
                elif row[name] == 0:
                    odds += math.log((1 - yes) / (1 - no))
            belief[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        for name in LABELERS:
            for side in (0, 1):
                mass = [r["n"] * (b if side else 1 - b) for r, b in zip(patterns, belief)]
                ones = sum(m for m, r in zip(mass, patterns) if r[name] == 1)
                cast = sum(m for m, r in zip(mass, patterns) if r[name] >= 0)
                # As if eight votes had been seen before, as expected at the start.
                rate[name][side] = (ones + 8 * (0.3, 0.9)[side]) / (cast + 8)
        for k in prior:
            own = [(r["n"], b) for r, b in zip(patterns, belief) if r["k"] == k]
            prior[k] = (sum(n * b for n, b in own) + 1.4) / (sum(n for n, _ in own) + 2)
    names = sorted({f for row in patterns for f in _features(row)} | {"bias"})
    weights, speed = dict.fromkeys(names, 0.0), dict.fromkeys(names, 1e-8)
    rows = [(_features(r), b, math.log1p(r["n"])) for r, b in zip(patterns, belief)]
    mass = sum(n for _, _, n in rows) or 1.0
    for _ in range(steps):
        slope = {name: 1e-3 * weights[name] for name in names}
        for features, wanted, n in rows:
            odds = sum(weights[f] for f in features)
            error = (1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))) - wanted) * n / mass
            for f in features:
                slope[f] += error
        for name in names:
            speed[name] += slope[name] ** 2
            weights[name] -= 0.5 * slope[name] / math.sqrt(speed[name])
    if not patterns:
        weights["bias"] = -1.0
    return Judgement({n: tuple(r) for n, r in rate.items()}, {KINDS[k]: p for k, p in prior.items()}, weights)


def judge(rows: DataFrame) -> Judgement:
    """Learn from all ``spans``; the driver gets the counts of vote patterns."""
    features = ["k", *LABELERS, "size"]
    patterns = rows.select(F.explode("spans").alias("x")).select("x.*").groupBy(
        *features).agg(F.count(F.lit(1)).alias("n")).collect()
    return learn(sorted((r.asDict() for r in patterns), key=lambda r: [r[f] for f in features]))


def _decided(spans: Column, judged: Judgement) -> Column:
    taken = F.filter(spans, lambda x: x["base"] | (judged.log_odds(x) >= 0))
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.sort_array(F.transform(taken, lambda x: F.struct(
        x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e"), x["base"].alias("base"))))
    return F.transform(ordered, lambda x: F.struct(
        F.get(names, x["k"]).alias("kind"), x["s"].alias("start"), x["e"].alias("end"), x["base"].alias("base")))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans`` for every row: array of ``kind, start, end, base``.

    Places are code points, the end is exclusive; spans are ordered by kind as
    listed in ``KINDS``, then start. Strict spans always stay, and of the
    proposed ones those that the classifier finds at least as likely as not.
    Null and empty texts have no spans; repeated rows are each returned; an
    empty table gives no rows and learns nothing.
    """
    rows = saved(candidates(picked(docs, doc_id=id_col, text=text_col), ["doc_id"]))
    return rows.select("doc_id", _decided(F.col("spans"), judge(rows)).alias("spans"))


def with_spans(docs: DataFrame, name: str, text_col: str = "text") -> DataFrame:
    """``docs`` with their spans as a further column.

    Null and empty texts have none; rows repeated whole have the same; further
    columns may have any name but ``name``; an empty table gives no rows.
    Patterns run once for the votes and once for the result: cheaper than
    shuffling whole texts to meet their spans.
    """
    whole = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"),
                        F.col(f"`{text_col}`").alias("text"))
    rows = candidates(whole, ["row"])
    return rows.select("row.*", _decided(F.col("spans"), judge(rows)).alias(name))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets.

    Spans of different kinds may overlap: what a span covers behind the end of
    the one before it goes too.
    """
    placed = F.sort_array(F.transform(spans, lambda x: F.struct(
        x["start"].alias("s"), x["end"].alias("e"), x["kind"].alias("kind"))))

    def add(a: Column, x: Column) -> Column:
        fresh = x["s"] >= a["pos"]
        kept = F.when(fresh, F.concat(F.substring(text, a["pos"] + 1, x["s"] - a["pos"]), F.lit("<"),
                                      F.upper(x["kind"]), F.lit(">"))).otherwise(F.lit(""))
        return F.struct(F.greatest(a["pos"], x["e"]).alias("pos"), F.concat(a["out"], kept).alias("out"))

    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))
    rest = lambda a: F.concat(a["out"], F.substring(text, a["pos"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(placed, start, add, rest)).otherwise(text)
