"""Bit-field and byte-level column expressions.

Signals are little-endian ("Intel") unsigned integers: the field starts at
bit ``start % 8`` of byte ``start // 8`` and takes the low bits first. A
field of up to 64 bits touches at most 9 bytes, so the extraction is written
as a fixed, unrolled OR of 9 shifted bytes: a plain scalar expression that
whole-stage codegen compiles, usable at top level or inside ``transform``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MAX_SPAN = 9  # bytes a 64-bit field can touch at a non-zero bit offset


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def idiv(x, n) -> Column:
    """Integer division truncating toward zero (SQL ``div``), exact for longs."""
    return F.call_function("div", _c(x), _c(n))


def _shl(x: Column, n: Column) -> Column:
    return F.call_function("shiftleft", x, n)


def _shr(x: Column, n: Column) -> Column:
    return F.call_function("shiftright", x, n)


def _ushr(x: Column, n: Column) -> Column:
    return F.call_function("shiftrightunsigned", x, n)


def payload_word(data) -> Column:
    """The first 8 payload bytes as one little-endian 64-bit word.

    Computed once per frame; every signal of a classic (<= 8 byte) frame is
    then a shift and a mask of this word.
    """
    data = _c(data)
    word = F.lit(0).cast("bigint")
    for k in range(8):
        byte = F.coalesce(F.get(data, k).cast("bigint"), F.lit(0).cast("bigint"))
        word = word.bitwiseOR(_shl(byte, F.lit(8 * k)))
    return word


def hex_payload_word(hex_text) -> Column:
    """Little-endian 64-bit word of the first 8 bytes of a hex payload text
    (``'10 50 01 2C'``): one ``conv`` of the byte-reversed digits, no array
    of bytes. Values >= 2^63 wrap to negative, as in ``payload_word``."""
    parts = F.slice(F.split(F.trim(_c(hex_text)), " +"), 1, 8)
    unsigned = F.conv(F.array_join(F.reverse(parts), ""), 16, 10).cast("decimal(20,0)")
    wrapped = F.when(unsigned >= F.lit(str(2**63)).cast("decimal(20,0)"), unsigned - F.lit(str(2**64)).cast("decimal(20,0)"))
    return wrapped.otherwise(unsigned).cast("bigint")


def hex_digits(hex_text) -> Column:
    """The digits of a hex payload text (two a byte), without its blanks."""
    return F.replace(_c(hex_text), F.lit(" "), F.lit(""))


_LOW_NIBBLES = 0x0F0F0F0F0F0F0F0F


def hex_digits_word(digits) -> Column:
    """``hex_payload_word`` of a payload's digits (see ``hex_digits``): the
    reversed digits as one signed number, then each byte's two digits swapped
    back. No array of tokens, no decimals."""
    low = F.lit(_LOW_NIBBLES).cast("bigint")
    turned = F.conv(F.reverse(F.substring(_c(digits), 1, 16)), 16, -10).cast("bigint")
    word = _shl(turned.bitwiseAND(low), F.lit(4)).bitwiseOR(_ushr(turned, F.lit(4)).bitwiseAND(low))
    return F.coalesce(word, F.lit(0).cast("bigint"))


def hex_payload_size(hex_text) -> Column:
    """Number of bytes in a hex payload text."""
    return F.size(F.split(F.trim(_c(hex_text)), " +"))


def extract_bits(data, start, length, word=None, size=None) -> Column:
    """Unsigned field of ``length`` bits (1..64) at bit ``start`` of ``data``.

    ``data`` is ``array<int>`` of bytes 0..255. Returns ``bigint`` (a 64-bit
    field >= 2^63 wraps to a negative value), or null when the field reaches
    beyond the payload or the length is outside 1..64. ``word`` may name a
    column already holding ``payload_word(data)``: payloads of up to 8 bytes
    then take the shift-and-mask path; ``size`` may give the payload byte
    count (default ``size(data)``), so ``data`` is only evaluated for
    payloads over 8 bytes.
    """
    data, start, length = _c(data), _c(start).cast("int"), _c(length).cast("int")
    general = _extract_general(data, start, length)
    if word is None:
        return general
    size = F.size(data) if size is None else _c(size)
    return F.when(_inside(start, length, size), F.when(size <= 8, _word_bits(word, start, length)).otherwise(general))


def extract_hex_bits(digits, start, length, word, size) -> Column:
    """``extract_bits`` of a hex payload: ``word`` and ``size`` as there,
    ``digits`` (see ``hex_digits``) is only looked at for payloads over 8
    bytes, and there only the nine bytes from the field's first one on."""
    start, length = _c(start).cast("int"), _c(length).cast("int")
    return F.when(_inside(start, length, _c(size)), F.when(_c(size) <= 8, _word_bits(word, start, length))
                  .otherwise(_digits_bits(digits, start, length)))


def _inside(start: Column, length: Column, size: Column) -> Column:
    return (length >= 1) & (length <= 64) & (start >= 0) & (start + length <= size * 8)


def _mask(length: Column) -> Column:
    return _ushr(F.lit(-1).cast("bigint"), F.lit(64) - length)


def _word_bits(word, start: Column, length: Column) -> Column:
    return _ushr(_c(word), start).bitwiseAND(_mask(length))


def _digits_bits(digits, start: Column, length: Column) -> Column:
    at = _shr(start, F.lit(3)) * 2 + 1
    offset = start.bitwiseAND(F.lit(7))
    cut = lambda pos, n: F.call_function("substring", _c(digits), pos, F.lit(n))
    ninth = F.conv(cut(at + 16, 2), 16, 10).cast("bigint")
    return (_ushr(hex_digits_word(cut(at, 16)), offset)
            .bitwiseOR(F.when(offset + length > 64, _shl(ninth, F.lit(64) - offset)).otherwise(F.lit(0).cast("bigint")))
            .bitwiseAND(_mask(length)))


def _extract_general(data: Column, start: Column, length: Column) -> Column:
    first = _shr(start, F.lit(3))
    offset = start.bitwiseAND(F.lit(7))
    nbytes = _shr(offset + length - 1, F.lit(3)) + 1
    acc = _shr(F.get(data, first).cast("bigint"), offset)
    for k in range(1, _MAX_SPAN):
        term = _shl(F.get(data, first + k).cast("bigint"), F.lit(8 * k) - offset)
        acc = acc.bitwiseOR(F.when(nbytes > k, term).otherwise(F.lit(0).cast("bigint")))
    mask = _ushr(F.lit(-1).cast("bigint"), F.lit(64) - length)
    return F.when((length >= 1) & (length <= 64) & (start >= 0), acc.bitwiseAND(mask))


def decode_array(data, info, word=None, size=None) -> Column:
    """Values of all signals of ``info`` (array<struct<startBit,signal_name,len>>)
    in ``info`` order, as ``array<bigint>``. Pass ``word`` (a column holding
    ``payload_word(data)``) to decode classic frames by shift and mask."""
    return F.transform(_c(info), lambda s: extract_bits(data, s["startBit"], s["len"], word, size))


#: signals of a message whose values are written out one by one: an array of
#: plain expressions is compiled, a lambda over the layout is interpreted. More
#: of them make methods over 8,000 bytes, which the JVM doesn't compile
WRITTEN_OUT = 8


def decode_layout(info, most: int, word, size, wide) -> Column:
    """``decode_array`` for layouts of at most ``most`` signals. ``word`` and
    ``size`` as in ``extract_bits``; ``wide(start, len)`` is the value in a
    payload over 8 bytes (more code: never written out). Small layouts of
    classic frames are written out."""
    info, size = _c(info), _c(size)

    def classic(s) -> Column:
        start, length = s["startBit"].cast("int"), s["len"].cast("int")
        return F.when(_inside(start, length, size), _word_bits(word, start, length))

    if 0 < most <= WRITTEN_OUT:
        short = F.slice(F.array(*[classic(F.get(info, k)) for k in range(most)]), F.lit(1), F.size(info))
    else:
        short = F.transform(info, classic)
    return F.when(size > 8, F.transform(info, lambda s: wide(s["startBit"], s["len"]))).otherwise(short)


def hex_bytes(hex_text) -> Column:
    """``'10 50 01'`` -> ``[16, 80, 1]`` (blank separated hex bytes)."""
    parts = F.split(F.trim(_c(hex_text)), " +")
    return F.transform(parts, lambda x: F.conv(x, 16, 10).try_cast("int"))


def bytes_to_hex(data) -> Column:
    """``[16, 80, 1]`` -> ``'10 50 01'`` (upper case, two digits per byte)."""
    return F.array_join(F.transform(_c(data), lambda b: F.lpad(F.upper(F.hex(b)), 2, "0")), " ")


def decode_map(data, info, word=None, size=None) -> Column:
    """Map form: signal name -> value, from ``data`` (array of bytes).

    With ``word``/``size`` (``hex_payload_word`` / ``hex_payload_size``)
    classic frames need no byte array (``data`` may be null). Signal names in ``info`` must
    be unique; the dictionary side applies the last-wins rule once per
    message (see ``SignalDictionary.with_unique_names``).
    """
    return F.map_from_arrays(_c(info)["signal_name"],
                             decode_array(data, info, word, size))


def hex_id_to_int(token) -> Column:
    """Hex frame id, optional trailing ``x`` (29-bit ids) -> int; null if not
    1-8 hex digits or beyond the int range (such a line becomes a reject).
    Plain string functions, no regex."""
    t = _c(token)
    t = F.when(t.endswith("x"), F.call_function("substring", t, F.lit(1), F.length(t) - 1)).otherwise(t)
    ok = F.length(t).between(1, 8) & F.unhex(t).isNotNull()
    return F.when(ok, F.conv(t, 16, 10).cast("bigint").try_cast("int"))


def seconds_to_ns(token) -> Column:
    """Decimal seconds -> nanoseconds, truncated toward zero (as a long cast)."""
    return (_c(token).try_cast("double") * F.lit(1e9)).try_cast("bigint")


def merge_timestamp(high_s, low_ns) -> Column:
    """Header seconds + nanoseconds -> microseconds since epoch."""
    # integer division truncating toward zero, as the recorder's int arithmetic
    low_us = idiv(_c(low_ns).cast("bigint"), 1000)
    return _c(high_s).cast("bigint") * F.lit(1000000) + low_us


def port_to_module(port_id) -> Column:
    """Recorder port id (signed byte) -> bus module number (port + 1)."""
    return (_c(port_id).cast("int") + 1).cast("smallint")


def signed_byte_to_unsigned(b) -> Column:
    return _c(b).cast("int").bitwiseAND(F.lit(255))


# Fixed layout of the 32-bit control word (name, shift, mask).
CONTROL_WORD_FIELDS = [
    ("EDL", 31, 0x1),
    ("BRS", 30, 0x1),
    ("ESI", 29, 0x1),
    ("unused_1", 28, 0x1),
    ("CODE", 24, 0xF),
    ("unused_2", 23, 0x1),
    ("SRR", 22, 0x1),
    ("IDE", 21, 0x1),
    ("RTR", 20, 0x1),
    ("DLC", 16, 0xF),
    ("TIMESTAMP", 0, 0xFFFF),
]


def control_word_fields(cs) -> Column:
    """int control word -> struct of its 11 bit fields (ints)."""
    cs = _c(cs).cast("int")
    return F.struct(*[
        _ushr(cs, F.lit(shift)).bitwiseAND(F.lit(mask)).alias(name)
        for name, shift, mask in CONTROL_WORD_FIELDS
    ])
