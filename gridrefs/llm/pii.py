"""Personal data in whole texts, with built-in functions only.

Regular expressions propose spans, checks confirm them: Luhn for card numbers, mod-97 for IBANs,
ranges for IP addresses, digit counts for phones. Words near a span adjust its score. The base
kinds keep every confirmed span whatever its score; the method adds

* ``iban``: letters and digits whose mod-97 remainder is 1;
* ``secret``: a long token after a word such as token, key or password;
* ``account``: 8 to 18 digits that are no card, if a context word nearby lifts the score.

The engine's functions give the matches of a pattern and the pieces between them; running sums
of their lengths in code points are the offsets. Patterns are possessive and start only where a
run of their characters starts, so that a long text costs time in proportion to its length and
no deep recursion; they match what the plain patterns match.

Cases: a null text is empty; no spans give counts 0, the hash of the empty string and an empty
``spans``; repeated rows give repeated results; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import let

#: Characters beside a span in which context words are looked for.
NEAR = 48


@dataclass(frozen=True)
class Kind:
    """A kind of span: its pattern, a cheap test for texts without any, and how it is scored."""

    name: str
    pattern: str
    sieve: str
    base: bool
    score: float  # of a confirmed span
    context: str  # words that raise the score
    against: str = ""  # words that lower it


#: Base kinds in their order, then what the method adds.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@[A-Za-z0-9-]", True, 0.9, "mail|contact|kontakt|correo|courriel"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]", True, 0.7, "ip|host|server|address|login", "version|release|section"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", r"[0-9]", True, 0.8, "card|visa|carte|karte|tarjeta|credit|payment", "order|isbn|serial"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", True, 0.8, "tel|phone|call|fax|mobile"),
    Kind("iban", r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Z0-9])", r"[A-Z]{2}[0-9]{2}", False, 0.8, "iban|bank|konto|compte|cuenta|account"),
    Kind("secret", r"(?i)(?<![a-z0-9])(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\x20{0,3}[:=]\x20{0,3}[\"']?[a-z0-9+/_-]{12,}+", r"[:=]", False, 0.6, "token|key|secret|password"),
    Kind("account", r"(?<![0-9A-Za-z+.-])[0-9]{8,18}+(?![0-9A-Za-z-])", r"[0-9]{8}", False, 0.3, "account|iban|konto|compte|cuenta|ssn|passport|customer|kunden", "order|isbn|serial|version"),
)
THRESHOLD = 0.5
CONTEXT_BONUS = 0.3
#: A part of an IP address, at most 255; zeros before it are free, and it may be all zeros.
IP = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's test."""
    reverse = F.reverse(F.split(digits, "")).cast("array<int>")
    total = F.aggregate(
        F.transform(reverse, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)),
        F.lit(0),
        lambda a, x: a + F.coalesce(x, F.lit(0)),
    )
    return total % 10 == 0


def _mod97(text: Column) -> Column:
    """Whether an IBAN's rearranged digits leave 1 modulo 97."""
    turned = F.concat(F.substr(text, F.lit(5)), F.substr(text, F.lit(1), F.lit(4)))
    return (
        F.aggregate(
            F.split(turned, ""),
            F.lit(0),
            lambda a, c: F.when(c == "", a).when(c.rlike("[0-9]"), (a * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
        )
        == 1
    )


def _confirmed(kind: Kind, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind.name == "ip":
        return match.rlike(f"^{IP}(?:\\.{IP}){{3}}$")
    if kind.name == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    if kind.name == "phone":
        return F.length(digits).between(8, 15)
    if kind.name == "iban":
        packed = F.replace(match, F.lit(" "), F.lit(""))
        return F.when(F.length(packed).between(15, 34), _mod97(packed)).otherwise(False)
    return F.lit(True)


def _spans(kind: Kind, text: Column) -> Column:
    """Array of (kind, start, end, score) of a kind's confirmed spans."""
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,score:double>>")
    matches, pieces = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), F.split(text, kind.pattern, -1)
    # For each match: length of the piece before it, the match, and what stands near it.
    near = F.lit(NEAR)
    parts = let(
        pieces,
        lambda p: F.transform(
            matches,
            lambda m, i: F.struct(
                F.length(F.get(p, i)).cast("bigint").alias("gap"),
                m.alias("match"),
                F.lower(F.concat(F.right(F.get(p, i), near), F.lit(" "), F.left(F.get(p, i + 1), near))).alias("near"),
            ),
        ),
    )
    first = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.length(x["match"])
        score = F.lit(kind.score) + F.when(x["near"].rlike(rf"\b(?:{kind.context})"), F.lit(CONTEXT_BONUS)).otherwise(0.0)
        if kind.against:
            score = score - F.when(x["near"].rlike(rf"\b(?:{kind.against})"), F.lit(CONTEXT_BONUS)).otherwise(0.0)
        keep = _confirmed(kind, x["match"])
        if not kind.base:
            keep = keep & (score >= THRESHOLD)
        span = F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), end.cast("bigint").alias("end"), F.round(score, 2).alias("score"))
        return F.struct(end.cast("bigint").alias("at"), F.when(keep, F.array_append(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    found = F.aggregate(parts, first, step, lambda acc: acc["out"])
    return F.when(text.rlike(kind.sieve), found).otherwise(none)


def find_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` as struct ``doc`` with an array of spans for each kind, named after it."""
    text = F.coalesce(F.col(f"doc.{text_col}"), F.lit(""))
    out = docs.select(F.struct("*").alias("doc"))
    return out.select("doc", *[_spans(k, text).alias(k.name) for k in KINDS])


def _joined(*spans: Column) -> Column:
    return F.array_join(F.transform(F.concat(*spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base kinds, the hash of their spans, and all spans, of each document."""
    base = [F.col(k.name) for k in KINDS if k.base]
    found = find_spans(docs, text_col)
    return found.select(
        F.col(f"doc.{id_col}").alias("doc_id"),
        *[F.size(k.name).cast("long").alias(f"n_{k.name}") for k in KINDS if k.base],
        F.sha2(_joined(*base), 256).alias("base_sha256"),
        _joined(*[F.col(k.name) for k in KINDS]).alias("spans"),
    )


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the base kinds' confirmed spans and the added ones replaced by ``<kind>``; overlaps are merged from the left."""
    kinds = [F.col(k.name) for k in KINDS]
    found = find_spans(docs, text_col).withColumn("all", F.array_sort(F.transform(F.concat(*kinds), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))))
    text = F.col(f"doc.{text_col}")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    piece = lambda a, b: F.substr(text, (a + 1).cast("int"), (b - a).cast("int"))
    done = F.aggregate(
        "all",
        start,
        lambda acc, s: F.when(s["start"] < acc["at"], acc).otherwise(F.struct(s["end"].alias("at"), F.concat(acc["out"], piece(acc["at"], s["start"]), F.lit("<"), s["kind"], F.lit(">")).alias("out"))),
        lambda acc: F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"), F.lit(2**31 - 1))),
    )
    return found.select(*[(done if c == text_col else F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])
