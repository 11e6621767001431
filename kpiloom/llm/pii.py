"""Personal data in whole texts: anchors are found by one automaton, local parsers expand and validate them.

An Aho-Corasick automaton reports at-signs, plus signs, digits, schemes and identifier cues. Each anchor goes to the parser
of its kind, which looks left and right of it, decides where the item starts and ends, and validates it. A parser never
starts before the end of its kind's last match, so matches of a kind are leftmost and do not overlap.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kpiloom.llm.common import as_rows, named, small_batches, worker_cache

#: Kinds in the order in which spans of one start are listed; the first four are the base.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "iban", "account")

#: Cues before an account or identity number, and schemes of addresses.
CUES = ("account", "acct", "konto", "compte", "cuenta", "ssn", "passport", "iban")
SCHEMES = ("http://", "https://", "ftp://")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){0,3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
URL = re.compile(r"[A-Za-z]+://[A-Za-z0-9.-]+(?::[0-9]+)?(?:[/?#][^\s<>\"']*)?")
IBAN = re.compile(r"[ :#=]{1,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
ACCOUNT = re.compile(r"(?:[ .]{1,2}(?:no|nr|num|number|id))?[ .:#=]{1,3}([A-Z0-9](?:[ -]?[A-Z0-9]){5,23})(?![A-Za-z0-9])")

SPAN = "array<struct<kind:string,start:long,end:long>>"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban_holds(text: str) -> bool:
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def anchors() -> object:
    """The automaton, one per worker."""
    kept = worker_cache("pii")
    if "automaton" not in kept:
        import ahocorasick

        found = ahocorasick.Automaton()
        for word, kind in [("@", "email"), ("+", "phone"), *((d, "digit") for d in "0123456789")]:
            found.add_word(word, (kind, 1))
        for scheme in SCHEMES:
            for form in (scheme, scheme.upper()):
                found.add_word(form, ("url", len(form)))
        for cue in CUES:
            for form in (cue, cue.title(), cue.upper()):
                found.add_word(form, ("iban" if cue == "iban" else "account", len(form)))
        found.make_automaton()
        kept["automaton"] = found
    return kept["automaton"]


def spans_of(text: str | None) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end in code points) by start, then kind as listed in ``KINDS``."""
    if not text:
        return []
    found = []
    done = dict.fromkeys(("email", "ip", "card", "phone", "url", "account"), 0)
    for last, (kind, size) in anchors().iter(text):
        at = last - size + 1
        if kind == "digit":
            if at >= done["card"]:
                done["card"] = at + 1
                if m := CARD.match(text, at):
                    done["card"] = m.end()
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 14 <= len(digits) <= 19 and luhn(digits):
                        found.append(("card", at, m.end()))
            if at >= done["ip"]:
                m = QUAD.match(text, at)
                done["ip"] = m.end()
                parts = m.group().split(".")
                if len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in parts):
                    found.append(("ip", at, m.end()))
        elif kind == "email":
            start = at
            while start > done["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                done["email"] = m.end()
                found.append(("email", start, m.end()))
        elif kind == "phone":
            if at >= done["phone"] and (m := PHONE.match(text, at)):
                done["phone"] = m.end()
                if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                    found.append(("phone", at, m.end()))
        elif kind == "url":
            if at >= done["url"] and (m := URL.match(text, at)):
                end = at + len(m.group().rstrip(".,;:!?)]"))
                done["url"] = end
                if "." in text[at:end].partition("://")[2]:
                    found.append(("url", at, end))
                else:  # what follows in the match has no dot either
                    done["url"] = m.end()
        elif last + 1 >= done["account"] and (at == 0 or not text[at - 1].isalnum()):
            if kind == "iban":
                if (m := IBAN.match(text, last + 1)) and iban_holds(m.group(1)):
                    found.append(("iban", m.start(1), m.end(1)))
                    done["account"] = m.end(1)
            elif (m := ACCOUNT.match(text, last + 1)) and sum(c.isdigit() for c in m.group(1)) >= 5:
                found.append(("account", m.start(1), m.end(1)))
                done["account"] = m.end(1)
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(found, key=lambda s: (s[1], order[s[0]]))


def find_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and spans (array of kind, start, end; code points, end exclusive) of every row.

    Null and empty texts have no spans. Null ids, repeated rows and texts of any length are treated like others; an empty
    table gives no rows. Other columns are not read. No shuffle: rows stay in the partition they were read in.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(named(id_col).alias("doc_id"), named(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", to_arrow_type(id_type)), ("spans", pa.list_(span))])

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in spans_of(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, schema.field(1).type)], schema=schema)

    return rows.mapInArrow(run, f"doc_id {id_type.simpleString()}, spans {SPAN}")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def masked_text(text: str | None) -> str | None:
    """``text`` with each span replaced by its kind in angle brackets; overlapping spans go as one, named by the first."""
    spans = spans_of(text)
    if not spans:
        return text
    out, at, k = [], 0, 0
    while k < len(spans):
        kind, start, end = spans[k]
        k += 1
        while k < len(spans) and spans[k][1] < end:
            end = max(end, spans[k][2])
            k += 1
        out += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` masked; every other column, whatever its name, and row stays as it is.

    A null text stays null, an empty one empty. Repeated rows stay repeated; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    rows = as_rows(docs)
    k = docs.columns.index(text_col)

    def run(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            own = batch.column(0)
            columns = [own.field(i) for i in range(own.type.num_fields)]
            columns[k] = pa.array([masked_text(t) for t in columns[k].to_pylist()], columns[k].type)
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(columns, fields=list(own.type))], ["row"])

    return rows.mapInArrow(run, rows.schema).select("row.*")
