"""PII redaction and statistics.

Recognisers look for their entity on their own and give spans (start, end,
entity, score); where spans overlap the best one stays (score, then length,
then place), and the text is cut once at the spans that stay. So no recogniser
sees another's placeholder, and neighbours are all found. Spans need the places
of matches, so the text goes through Python in Arrow batches; texts that hold
neither a digit nor an ``@`` stay in the JVM. Statistical entities (PERSON,
DATE_TIME) need a trained model and are not built.

Passports and paper identity cards share one shape (two letters, seven
digits); written without a space it is reported as a passport.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .reports import FISCAL_ALPHABET, FISCAL_ODD_VALUES

# ---------------------------------------------------------------- fixed values
# ASCII word boundaries that consume nothing.
LEFT = "(?<![0-9A-Za-z_])"
RIGHT = "(?![0-9A-Za-z_])"
# Length of an IBAN by country (the public registry of ISO 13616).
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24,
    "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28,
    "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20,
    "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22,
    "VG": 24, "XK": 20,
}
PII_ENTITIES = ("EMAIL_ADDRESS", "IBAN_CODE", "CREDIT_CARD", "IT_FISCAL_CODE", "IT_VAT_CODE", "IT_DRIVER_LICENSE", "IT_PASSPORT", "IT_IDENTITY_CARD",
                "IT_VEHICLE_PLATE", "PHONE_NUMBER")
# Entities masked (trailing characters → '*') instead of replaced in mask mode.
MASKED = {"IT_VEHICLE_PLATE": 2, "IT_FISCAL_CODE": 10}
PLATE_CF_VAT = ("IT_VEHICLE_PLATE", "IT_FISCAL_CODE", "IT_VAT_CODE")
# ------------------------------------------------------------------------------

Span = tuple[int, int, str, float]


def luhn(number: str) -> bool:
    """Whether the digits of ``number`` (separators ignored) pass the Luhn check."""
    digits = [int(c) for c in reversed(number) if c.isdigit()]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def vat(code: str) -> bool:
    """The check digit of an 11-digit VAT number, which is Luhn's."""
    return luhn(code)


def fiscal(code: str) -> bool:
    """The check character of a personal tax code, in either case."""
    code = code.upper()
    total = 0
    for i, c in enumerate(code[:15]):
        at = FISCAL_ALPHABET.index(c)
        total += FISCAL_ODD_VALUES[at] if i % 2 == 0 else at if at < 10 else at - 10
    return chr(65 + total % 26) == code[15]


def mod97(iban: str) -> bool:
    """ISO 7064: country and check digits to the end, letters as 10-35, remainder 1."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _matches(pattern: str, check: Callable[[str], bool] | None = None, flags: int = 0) -> Callable[[str], Iterator[tuple[int, int]]]:
    compiled = re.compile(pattern, flags | re.A)

    def found(text: str) -> Iterator[tuple[int, int]]:
        for m in compiled.finditer(text):
            if check is None or check(m[0]):
                yield m.span()

    return found


_IBAN_START = re.compile(LEFT + "[A-Z]{2}[0-9]{2}", re.I | re.A)
_ALNUM = frozenset("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """As many letters and digits as the country has, with at most one space or dash between two of them."""
    for m in _IBAN_START.finditer(text):
        length, code, at = IBAN_LENGTHS.get(m[0][:2].upper(), 0), [], m.start()
        while len(code) < length and at < len(text):
            if text[at] in _ALNUM:
                code.append(text[at])
            elif text[at] not in " -" or text[at - 1] in " -":
                break
            at += 1
        if code and len(code) == length and text[at:at + 1] not in _ALNUM | {"_"} and mod97("".join(code).upper()):
            yield m.start(), at


_CARD = (r"(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?:\1[0-9]{3})?|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5})")
_FISCAL = "[A-Z]{6}[0-9LMNPQRSTUV]{2}[ABCDEHLMPRST][0-9LMNPQRSTUV]{2}[A-Z][0-9LMNPQRSTUV]{3}[A-Z]"
# (entity, what any text with it contains, score, recogniser); several may look for one entity.
RECOGNISERS: tuple[tuple[str, str, float, Callable[[str], Iterator[tuple[int, int]]]], ...] = (
    ("EMAIL_ADDRESS", "@", 1.0, _matches(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}")),
    ("IBAN_CODE", "", 1.0, _ibans),
    ("CREDIT_CARD", "", 1.0, _matches(LEFT + _CARD + RIGHT, luhn)),
    ("IT_FISCAL_CODE", "", 1.0, _matches(LEFT + _FISCAL + RIGHT, fiscal, re.I)),
    ("IT_VAT_CODE", "", 1.0, _matches(LEFT + "[0-9]{11}" + RIGHT, vat)),
    ("IT_DRIVER_LICENSE", "", 0.9, _matches(LEFT + "(?:[A-Z]{2}[0-9]{7}[A-Z]|U1[BCDFGHLJKMNPRSTUWYXZ0-9]{7}[A-Z])" + RIGHT)),
    ("IT_PASSPORT", "", 0.8, _matches(LEFT + "[A-Za-z]{2}[0-9]{7}" + RIGHT)),
    ("IT_IDENTITY_CARD", "", 0.7, _matches(LEFT + "(?:[A-Za-z]{2} [0-9]{7}|[0-9]{7}[A-Za-z]{2}|[A-Za-z]{2}[0-9]{5}[A-Za-z]{2})" + RIGHT)),
    ("IT_VEHICLE_PLATE", "", 0.8, _matches(LEFT + "(?:[A-Z]{2}[0-9]{3}[A-Z]{2}|[0-9]{2}[A-Z]{2}[0-9]{2}|[A-Z]{2}[0-9]{5}|[0-9]{2}[A-Z]{3}[0-9]{2})" + RIGHT)),
    ("PHONE_NUMBER", "+", 0.75, _matches(r"\+[0-9]{1,3} ?\(?[0-9]{2,4}\)?[ -]?[0-9]{3}[ -]?[0-9]{3,4}" + RIGHT)),
    # national numbers: mobile, and land lines with the prefix set apart
    ("PHONE_NUMBER", "3", 0.4, _matches(LEFT + "3[0-9]{2}[ .-]?[0-9]{3}[ .-]?[0-9]{3,4}" + RIGHT)),
    ("PHONE_NUMBER", "0", 0.4, _matches(LEFT + "0[0-9]{1,3}[ /-][0-9]{5,8}" + RIGHT)),
)
SPANS = "array<struct<start:int,end:int,entity:string,score:double>>"
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("entity", pa.string()), ("score", pa.float64())]))


def recognised(text: str, entities: Sequence[str] = PII_ENTITIES) -> list[Span]:
    """The spans of every recogniser, overlaps included."""
    return [(start, end, entity, score) for entity, needs, score, found in RECOGNISERS if entity in entities and needs in text
            for start, end in found(text)]


def resolved(spans: list[Span]) -> list[Span]:
    """The best spans that do not overlap, by place: the higher score, the longer, the earlier, the entity listed first."""
    starts: list[int] = []
    kept: list[Span] = []
    for span in sorted(spans, key=lambda s: (-s[3], s[0] - s[1], s[0], PII_ENTITIES.index(s[2]))):
        k = bisect_left(starts, span[0])
        if (k == 0 or kept[k - 1][1] <= span[0]) and (k == len(kept) or span[1] <= starts[k]):
            starts.insert(k, span[0])
            kept.insert(k, span)
    return kept


def cut(text: str, spans: list[Span], mode: str = "replace") -> str:
    """``text`` with a placeholder, or stars, at each span."""
    out, at = [], 0
    for start, end, entity, _ in spans:
        n = MASKED.get(entity) if mode == "mask" else None
        keep = max(end - start - n, 0) if n is not None else 0
        out += [text[at:start], f"<{entity}>" if n is None else text[start:start + keep] + "*" * (end - start - keep)]
        at = end
    return "".join(out) + text[at:]


def _possible(text: Column) -> Column:
    """The text if any entity can be in it, else null."""
    return F.when(text.rlike("[0-9@]"), text)


def pii_spans(df: DataFrame, col: str, out_col: str = "spans", entities: Sequence[str] = PII_ENTITIES) -> DataFrame:
    """The spans that stay in each text, places counted in characters from 0; null for a null text."""
    wanted = tuple(entities)

    @F.arrow_udf(SPANS)
    def spans(texts: pa.Array) -> pa.Array:
        return pa.array([[] if t is None else [dict(zip(("start", "end", "entity", "score"), s)) for s in resolved(recognised(t, wanted))]
                         for t in texts.to_pylist()], _ARROW_SPANS)

    return df.withColumn(out_col, F.when(F.col(col).isNotNull(), spans(_possible(F.col(col)))))


def redact(df: DataFrame, col: str, mode: str = "replace", out_col: str | None = None,
           entities: Sequence[str] = PII_ENTITIES) -> DataFrame:
    """Add (or overwrite) the redacted text column; ``mode="mask"`` stars out plates and tax codes."""
    wanted = tuple(entities)

    @F.arrow_udf("string")
    def redacted(texts: pa.Array) -> pa.Array:
        return pa.array([None if t is None else cut(t, resolved(recognised(t, wanted)), mode) for t in texts.to_pylist()], pa.string())

    return df.withColumn(out_col or col, F.coalesce(redacted(_possible(F.col(col))), F.col(col)))


def found_entities(redacted: Column) -> Column:
    """Entities whose placeholder occurs in the redacted text (fixed order)."""
    return F.filter(F.array(*[F.when(redacted.contains(f"<{e}>"), F.lit(e)) for e in PII_ENTITIES]),
                    lambda x: x.isNotNull())


def pii_entity_counts(df: DataFrame, redacted_col: str) -> DataFrame:
    """Rows per detected entity."""
    return (df.select(F.explode(found_entities(F.col(redacted_col))).alias("entity"))
            .groupBy("entity").agg(F.count(F.lit(1)).alias("n")))


def pii_combinations(df: DataFrame, redacted_col: str) -> DataFrame:
    """Rows per entity combination ('SOLO X' for a single entity, else the
    sorted names joined by '-'), plus the plate/tax-code/VAT any-vs-none split.
    One pass: every row contributes its combination label and its split label
    to a single aggregation."""
    found = df.select(found_entities(F.col(redacted_col)).alias("found"))
    f = F.col("found")
    combo = F.when(F.size(f) == 1, F.concat(F.lit("SOLO "), F.element_at(f, 1))).when(
        F.size(f) > 1, F.array_join(F.array_sort(f), "-"))
    any_key = F.exists(f, lambda x: x.isin(*PLATE_CF_VAT))
    group = F.when(any_key, F.lit("ANY " + "/".join(PLATE_CF_VAT))).otherwise(F.lit("NONE " + "/".join(PLATE_CF_VAT)))
    labels = found.select(F.explode(F.array(combo, group)).alias("combination"))
    return labels.where(F.col("combination").isNotNull()).groupBy("combination").agg(F.count(F.lit(1)).alias("n"))
