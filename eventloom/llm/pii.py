r"""Personal data, found in Spark expressions only.

Every kind has a pattern that proposes spans, a check that confirms them (Luhn for
cards, mod 97 for bank accounts, ranges for addresses) and words that speak for it
nearby.  A span's score is what pattern and check are worth plus what a context word
adds; spans under ``THRESHOLD`` go.  ``email``, ``ip``, ``card`` and ``phone`` reach the
threshold by their check alone, so context only moves their score; ``ssn`` and
``local_phone`` need a context word, ``iban`` its check sum.

Spark has no expression for the places of all matches, so they come from two that
agree with each other: the pieces between the matches (``split``) and the matches
(``regexp_extract_all``).  A match starts where all pieces and matches before it end;
the running sum is taken in chunks, so a text of very many matches costs no square.
Context is read from the piece on either side, hence never beyond the neighbouring
match of the same kind.  A text without a kind's pattern costs one search.

The patterns give the same matches as the plain ones quoted beside them, but never
step back and never start twice inside one run, so that a run of a million digits or
letters takes linear time and no stack.

Defined results: null text is empty and has no spans; empty texts and tables give none;
texts are read whole; repeated rows and ids, null ids and further columns pass through
untouched, one row out for each row in; spans are code points, end exclusive, ordered
by kind as listed, then start, and spans of different kinds may overlap.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import UPPER

THRESHOLD = 0.5
BEFORE, AFTER = 40, 20
CHUNK = 128
BONUS = 0.3

# The length of a bank account number by country.
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "CH": 21, "CZ": 24, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22,
    "GR": 27, "HU": 28, "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24,
}
ALNUM = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check."""
    n = F.length(digits)

    def term(i: Column) -> Column:
        twice = F.substring(digits, i, F.lit(1)).cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), lambda total, i: total + term(i)) % 10 == 0


def mod97(code: Column) -> Column:
    """Remainder by 97 of an account number, its first four signs moved to the end."""
    turned = F.concat(F.substring(code, F.lit(5), F.length(code)), F.left(code, F.lit(4)))

    def step(rest: Column, i: Column) -> Column:
        value = F.instr(F.lit(ALNUM), F.substring(turned, i, F.lit(1))) - 1
        return (rest * F.when(value > 9, 100).otherwise(10) + value) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step)


def _email(match, before, after):
    return F.length(match)


def _ip(match, before, after):
    parts = F.transform(F.split(match, r"\."), lambda part: F.regexp_replace(part, "^0+", ""))
    fits = F.forall(parts, lambda part: (F.length(part) < 3) | ((F.length(part) == 3) & (part.try_cast("int") <= 255)))
    return F.when(fits, F.length(match))


def _card(match, before, after):
    digits = digits_of(match)
    return F.when(F.length(digits).between(13, 19), F.when(luhn(digits), F.length(match)))


def _phone(match, before, after):
    return F.when(F.length(digits_of(match)).between(9, 15), F.length(match))


def _iban(match, before, after):
    lengths = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])
    wanted = F.element_at(lengths, F.left(match, F.lit(2)))
    end = F.array_min(F.filter(
        F.sequence(F.lit(1), F.length(match)),
        lambda i: F.length(F.replace(F.left(match, i), F.lit(" "), F.lit(""))) == wanted,
    ))
    code = F.replace(F.left(match, end), F.lit(" "), F.lit(""))
    follows = F.concat(F.substring(match, end + 1, F.lit(1)), F.left(after, F.lit(1)))
    alone = ~before.rlike("[A-Za-z0-9]$") & ~follows.rlike("^[A-Za-z0-9]")
    return F.when(end.isNotNull() & alone, F.when(mod97(code) == 1, end))


def _apart(before, after):
    """The number is no part of a longer one."""
    return ~before.rlike(r"[+0-9][ ().-]*$") & ~after.rlike(r"^[ .-]?[0-9]")


def _ssn(match, before, after):
    issued = ~match.rlike("^(000|666|9)") & ~match.rlike("-00-") & ~match.rlike("0000$")
    return F.when(issued & _apart(before, after), F.length(match))


def _local_phone(match, before, after):
    return F.when(_apart(before, after), F.length(match))


@dataclass(frozen=True)
class Kind:
    """How spans of one kind are proposed, confirmed and scored.

    ``end`` gives the length of the confirmed part of a match, null if it fails; it
    reads the match and up to ``BEFORE`` and ``AFTER`` code points around it.  ``plain``
    is the pattern as written without the guards against stepping back.
    """

    name: str
    pattern: str
    end: Callable[[Column, Column, Column], Column]
    score: float
    words: tuple[str, ...]
    plain: str = ""
    needs: str = ""


KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", _email, 0.7,
         ("email", "mail", "contact", "write", "correo", "courriel"),
         r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "@"),
    Kind("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", _ip, 0.5, ("ip", "address", "server", "host", "client"),
         r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", _card, 0.6,
         ("card", "visa", "mastercard", "credit", "tarjeta", "carte", "karte"), r"[0-9]([\x20-]?[0-9])+"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _phone, 0.6,
         ("phone", "tel", "telephone", "call", "mobile", "fax", "telefon"), r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+", _iban, 0.7,
         ("iban", "account", "bank", "konto", "cuenta", "compte"), r"[A-Z]{2}[0-9]{2}( ?[A-Z0-9]){11,30}"),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", _ssn, 0.3, ("ssn", "social security"), r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
    Kind("local_phone", r"(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}", _local_phone, 0.3,
         ("phone", "tel", "telephone", "call", "mobile", "fax", "telefon"),
         r"(\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"),
)
BASE = ("email", "ip", "card", "phone")

SPAN = "array<struct<kind:string,start:int,end:int,score:double,text:string>>"


def running_sums(values: Column) -> Column:
    """The running sums of an array column of whole numbers, taken chunk by chunk.

    ``values`` must be a column, not an expression: each chunk would evaluate it anew.
    """
    none = F.array().cast("array<bigint>")

    def within(chunk: Column, base: Column) -> Column:
        return F.aggregate(
            chunk, F.struct(base.alias("at"), none.alias("sums")),
            lambda s, x: F.struct((s["at"] + x).alias("at"), F.concat(s["sums"], F.array(s["at"] + x)).alias("sums")),
            lambda s: s["sums"],
        )

    def total(chunk: Column) -> Column:
        return F.aggregate(chunk, F.lit(0).cast("bigint"), lambda s, x: s + x)

    starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(CHUNK))
    return F.aggregate(
        F.transform(starts, lambda at: F.slice(values, at, CHUNK)),
        F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<array<bigint>>").alias("done")),
        lambda s, chunk: F.struct(
            (s["at"] + total(chunk)).alias("at"), F.concat(s["done"], F.array(within(chunk, s["at"]))).alias("done")
        ),
        lambda s: F.flatten(s["done"]),
    )


def _proposals(text: Column, kind: Kind) -> Column:
    """Struct of the matches and the pieces around them; null where nothing matches."""
    found = F.struct(
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("match"),
        F.transform(F.split(text, kind.pattern, -1), lambda piece: F.struct(
            F.length(piece).cast("bigint").alias("chars"),
            F.right(piece, F.lit(BEFORE)).alias("tail"), F.left(piece, F.lit(AFTER)).alias("head"),
        )).alias("piece"),
    )
    there = text.rlike(kind.pattern)
    return F.when((text.contains(kind.needs) & there) if kind.needs else there, found)


def _steps(found: Column) -> Column:
    """From the start of one match to the start of the next."""
    return F.transform(found["match"], lambda m, i: F.get(found["piece"], i)["chars"] + F.when(
        i == 0, F.lit(0).cast("bigint")).otherwise(F.length(F.get(found["match"], i - 1)).cast("bigint")))


def _context(kind: Kind, before: Column, after: Column) -> Column:
    near = F.translate(F.concat(before, F.lit(" "), after), UPPER, UPPER.lower())
    return near.rlike(f"(^|[^a-z])({'|'.join(kind.words)})([^a-z]|$)")


def _spans(found: Column, starts: Column, kind: Kind) -> Column:
    def span(match: Column, i: Column) -> Column:
        before, after = F.get(found["piece"], i)["tail"], F.get(found["piece"], i + 1)["head"]
        start, end = F.get(starts, i), kind.end(match, before, after)
        score = F.lit(kind.score) + F.when(_context(kind, before, after), F.lit(BONUS)).otherwise(F.lit(0.0))
        return F.when(end.isNotNull(), F.struct(
            F.lit(kind.name).alias("kind"), start.cast("int").alias("start"), (start + end).cast("int").alias("end"),
            score.alias("score"), F.left(match, end).alias("text"),
        ))

    return F.filter(F.transform(found["match"], span), lambda s: s.isNotNull() & (s["score"] >= THRESHOLD))


def find_pii(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS, text: str = "text", into: str = "pii") -> DataFrame:
    """``docs`` with ``into``, the spans of every row: kind, start, end, score and text."""
    def own(label: str) -> str:
        while any(c.lower().startswith(label) for c in docs.columns):
            label = "_" + label
        return label

    whole, found, steps, starts = own("whole_text"), own("found"), own("steps"), own("starts")
    kept = [c for c in docs.columns if c != into]
    df = docs.withColumn(whole, F.coalesce(F.col(text).cast("string"), F.lit("")))
    df = df.select(*kept, *[_proposals(F.col(whole), k).alias(f"{found}_{k.name}") for k in kinds])
    df = df.select("*", *[_steps(F.col(f"{found}_{k.name}")).alias(f"{steps}_{k.name}") for k in kinds])
    df = df.select("*", *[running_sums(F.col(f"{steps}_{k.name}")).alias(f"{starts}_{k.name}") for k in kinds])
    parts = [
        F.coalesce(_spans(F.col(f"{found}_{k.name}"), F.col(f"{starts}_{k.name}"), k), F.array().cast(SPAN)) for k in kinds
    ]
    return df.select(*kept, F.concat(*parts).cast(SPAN).alias(into))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def pii_digest(found: DataFrame) -> DataFrame:
    """Per row the counts and digest of the base kinds, and all spans as text."""
    def count(kind: str) -> Column:
        return F.size(F.filter("pii", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = F.filter("pii", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id", *[count(kind) for kind in BASE], F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("pii")).alias("spans"),
    )


def _sql() -> str:
    """The same spans in SQL, from the plain patterns."""
    confirmed = {
        "email": "length(m)",
        "ip": "CASE WHEN list_bool_and(list_transform(string_split(m, '.'), lambda x: coalesce(try_cast(ltrim(x, '0') AS INTEGER), "
              "CASE WHEN ltrim(x, '0') = '' THEN 0 ELSE 256 END) <= 255)) THEN length(m) END",
        "card": "CASE WHEN length(d) BETWEEN 13 AND 19 AND list_sum(list_transform(range(1, length(d) + 1), lambda i: "
                "CASE WHEN (length(d) - i) % 2 = 0 THEN substr(d, i, 1)::INTEGER "
                "ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][substr(d, i, 1)::INTEGER + 1] END)) % 10 = 0 THEN length(m) END",
        "phone": "CASE WHEN length(d) BETWEEN 9 AND 15 THEN length(m) END",
        "iban": "CASE WHEN cut IS NOT NULL AND NOT regexp_matches(before, '[A-Za-z0-9]$') AND NOT "
                "regexp_matches(substr(m, cut + 1, 1) || substr(after, 1, 1), '^[A-Za-z0-9]') AND list_reduce([0] || "
                "list_transform(range(1, length(code) + 1), lambda i: instr(alnum, substr(substr(code, 5) || code[:4], i, 1)) - 1), "
                "lambda r, v: (r * CASE WHEN v > 9 THEN 100 ELSE 10 END + v) % 97) = 1 THEN cut END",
        "ssn": "CASE WHEN apart AND NOT regexp_matches(m, '^(000|666|9)') AND NOT contains(m, '-00-') "
               "AND NOT regexp_matches(m, '0000$') THEN length(m) END",
        "local_phone": "CASE WHEN apart THEN length(m) END",
    }
    lengths = ", ".join(f"'{c}': {n}" for c, n in IBAN_LENGTHS.items())
    proposed, cases, scores, words = [], [], [], []
    for at, kind in enumerate(KINDS):
        proposed.append(
            f"SELECT rid, {at} AS k, '{kind.name}' AS kind, regexp_extract_all(t, '{kind.plain}') AS ms, "
            f"string_split_regex(t, '{kind.plain}') AS ps FROM r WHERE regexp_matches(t, '{kind.plain}')"
        )
        cases.append(f"WHEN {at} THEN {confirmed[kind.name]}")
        scores.append(f"WHEN {at} THEN {kind.score!r}")
        words.append(f"WHEN {at} THEN regexp_matches(near, '(^|[^a-z])({'|'.join(kind.words)})([^a-z]|$)')")
    return f"""
WITH r AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({' UNION ALL '.join(proposed)}),
one AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM found),
near AS (
  SELECT rid, k, kind, ms[i] AS m, right(ps[i], {BEFORE}) AS before, left(ps[i + 1], {AFTER}) AS after,
    (list_sum(list_transform(ps[:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[:i - 1], lambda x: length(x))), 0))::BIGINT AS start
  FROM one),
read AS (
  SELECT *, regexp_replace(m, '[^0-9]', '', 'g') AS d, '{ALNUM}' AS alnum,
    translate(before || ' ' || after, '{UPPER}', '{UPPER.lower()}') AS near,
    NOT regexp_matches(before, '[+0-9][ ().-]*$') AND NOT regexp_matches(after, '^[ .-]?[0-9]') AS apart,
    list_min(list_filter(range(1, length(m) + 1), lambda i: length(replace(left(m, i), ' ', '')) = MAP {{{lengths}}}[left(m, 2)])) AS cut
  FROM near),
checked AS (SELECT *, CASE k {' '.join(cases)} END AS size
  FROM (SELECT *, replace(left(m, cut), ' ', '') AS code FROM read)),
kept AS (
  SELECT rid, k, start, kind || ':' || start || ':' || (start + size) AS span, kind FROM checked
  WHERE size IS NOT NULL AND CASE k {' '.join(scores)} END + CASE WHEN CASE k {' '.join(words)} END THEN {BONUS} ELSE 0 END >= {THRESHOLD}),
told AS (
  SELECT rid, {', '.join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in BASE)},
    string_agg(span, ',' ORDER BY k, start) FILTER (WHERE k < {len(BASE)}) AS base, string_agg(span, ',' ORDER BY k, start) AS spans
  FROM kept GROUP BY rid)
SELECT doc_id, {', '.join(f'coalesce(n_{k}, 0)::BIGINT AS n_{k}' for k in BASE)},
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM r LEFT JOIN told USING (rid)
"""


SQL = _sql()
