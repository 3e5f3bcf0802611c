"""Column expressions for the parts of a statement: IRIs, literals, N-Triples."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F, types as T

# N-Triples grammar (W3C). String escapes of a quoted literal.
LITERAL_ESCAPES = [
    ("\\", "\\\\"),
    ('"', '\\"'),
    ("\n", "\\n"),
    ("\r", "\\r"),
    ("\t", "\\t"),
]

# Characters an N-Triples IRI may only carry as a numeric escape.
IRI_ESCAPES = [
    ("\\", "\\u005C"),
    (" ", "\\u0020"),
    ('"', "\\u0022"),
    ("<", "\\u003C"),
    (">", "\\u003E"),
    ("^", "\\u005E"),
    ("`", "\\u0060"),
    ("{", "\\u007B"),
    ("|", "\\u007C"),
    ("}", "\\u007D"),
    *[(chr(code), f"\\u{code:04X}") for code in range(0x20)],
]

IRI_FORBIDDEN = r'[\x00-\x20<>"{}|^`\\]'
ABSOLUTE_IRI = "^[A-Za-z][A-Za-z0-9+.-]*:"


def encode_part(value: Column) -> Column:
    """RFC 3986 percent-encoding of one template value.

    ``url_encode`` is form encoding, so its three differences are put right.
    """
    encoded = F.url_encode(value)
    for form, rfc in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        encoded = F.replace(encoded, F.lit(form), F.lit(rfc))
    return encoded


def resolve_iri(value: Column, base: str) -> Column:
    """Keep an absolute IRI, put ``base`` before anything else."""
    return F.when(value.rlike(ABSOLUTE_IRI), value).otherwise(F.concat(F.lit(base), value))


def needs_encoding(dtype: T.DataType) -> bool:
    """Whole numbers hold no reserved character, so templates skip the encoder."""
    return not isinstance(dtype, T.IntegralType)


def lexical(dtype: T.DataType) -> Callable[[Column], Column]:
    """How a scalar of this type is written as a string."""
    if isinstance(dtype, T.StringType):
        return lambda c: c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return lambda c: F.replace(c.cast("string"), F.lit(" "), F.lit("T"))
    if isinstance(dtype, T.BinaryType):
        return F.base64
    if isinstance(dtype, (T.StructType, T.MapType)):
        raise ValueError(f"cannot write {dtype.simpleString()} as one value; name a field inside it")
    return lambda c: c.cast("string")


def _escape(value: Column, table: list[tuple[str, str]]) -> Column:
    for raw, escaped in table:
        value = F.replace(value, F.lit(raw), F.lit(escaped))
    return value


def ntriples_line(s: Column, p: Column, o: Column, kind: Column) -> Column:
    """One N-Triples line for a statement."""

    def iri(value: Column) -> Column:
        # few identifiers hold such a character, and the test is one scan
        escaped = F.when(value.rlike(IRI_FORBIDDEN), _escape(value, IRI_ESCAPES)).otherwise(value)
        return F.concat(F.lit("<"), escaped, F.lit(">"))

    literal = F.concat(F.lit('"'), _escape(o, LITERAL_ESCAPES), F.lit('"'))
    target = F.when(kind == "literal", literal).otherwise(iri(o))
    return F.concat_ws(" ", iri(s), iri(p), target, F.lit("."))
