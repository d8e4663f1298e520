"""Explicit schemas of the document-unit tables. Built without a session, so modules import before one starts."""

from pyspark.sql import types as T

S, I, B = T.StringType(), T.IntegerType(), T.BooleanType()
STRINGS = T.ArrayType(S)


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


SPANS = T.MapType(S, struct(type=S, md=S, rid=S))
UNIT_ROW = struct(ordinal=I, unit_id=S, kind=S, level=I, src_id=S, translate=B, text=S, spans=SPANS, source_md=S, fixed=S, label=S, graphics=STRINGS)
UNIT = T.StructType([T.StructField("doc_id", S), *UNIT_ROW.fields])
TRANSLATION = struct(doc_id=S, unit_id=S, status=S, text=S, error=S, repaired=S, manual=B)
TERM = struct(label=S, en=STRINGS, ru=STRINGS, ru_raw=S, note=S, ru_stems=STRINGS, gloss=S, paren_en=S)
ISSUE = struct(doc_id=S, unit_id=S, check=S, severity=S, message=S)
STATE = struct(slug=S, last_step=S, exit_code=I, ts=T.TimestampType())
PAPER = struct(
    slug=S, title=S, authors=STRINGS, doi=S, pmcid=S, arxiv=S, pdf=S, url=S, journal=S, year=I, license=S, status=S, topics=STRINGS, difficulty=I, difficulty_note=S, body=S
)
CATALOG = struct(slug=S, title_ru=S, title=S, authors=S, year=I, topics=STRINGS, difficulty=I, reading_minutes=I)
CHAT = T.ArrayType(struct(role=S, content=S))
EXCEPTION = struct(doc_id=S, unit_id=S, terms=STRINGS)
RULES = struct(banned_calques=T.ArrayType(struct(bad=S, good=S)))
PROTECTED = struct(terms=STRINGS, patterns=STRINGS)
#: Matches of terms in a unit.
MATCHES = T.ArrayType(struct(label=S, pos=I))
#: The kinds a unit may have.
KINDS = ("title", "heading", "para", "figure", "supplementary", "ref")
