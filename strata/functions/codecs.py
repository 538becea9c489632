"""Order-preserving key codecs, keyspaces and display forms, as column expressions.

Binary columns compare as unsigned bytes, the shorter prefix first, like the keys they hold.  Broken
input decodes to null.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Group size and markers of the memcomparable form; mode bytes of the two keyspace kinds.
GROUP, PAD_MARK = 8, 0xFF
RAW_MODE, TXN_MODE = 0x72, 0x78
SIGN = -(1 << 63)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once a row, however often ``use`` names it.

    A column that is named many times is worked out as many times, and within a lambda function once for every element.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def next_key(key: Column) -> Column:
    """Smallest key after ``key``."""
    return F.concat(key, F.lit(b"\x00"))


def prefix_next_key(key: Column) -> Column:
    """Smallest key after all keys with this prefix; empty (no bound) if there is none."""
    head = F.regexp_replace(F.hex(key), "^((?:..)*?)(?:FF)*$", "$1")
    last = F.conv(F.substring(head, -2, 2), 16, 10).cast("int") + 1
    return F.when(head == "", F.lit(b"")).otherwise(F.unhex(F.concat(F.expr("''"), F.substring(head, F.lit(1), F.length(head) - 2), F.lpad(F.hex(last), 2, "0"))))


def compare_keys(a: Column, b: Column) -> Column:
    return F.when(a < b, -1).when(a > b, 1).otherwise(0)


def encode_bytes(value: Column) -> Column:
    """Memcomparable form: groups of eight bytes, zero-padded, each followed by 255 minus its padding."""
    wide = 2 * GROUP

    def code(text: Column) -> Column:
        rest = F.length(text) % wide
        groups = F.regexp_replace(text, f"(.{{{wide}}})", f"$1{PAD_MARK:02X}")
        return F.unhex(F.concat(groups, F.repeat(F.lit("0"), wide - rest), F.hex((PAD_MARK - GROUP + rest / 2).cast("int"))))

    return _let(F.hex(value), code)


#: Full groups, then one that is padded by one byte at least: zeros, as many as its marker says.
ENCODED = f"^(?:.{{{2 * GROUP}}}{PAD_MARK:02X})*+(?:{'|'.join(f'.{{{2 * k}}}0{{{2 * (GROUP - k)}}}{PAD_MARK - GROUP + k:02X}' for k in range(GROUP))})$"


def decode_bytes(encoded: Column) -> Column:
    """Inverse of ``encode_bytes`` for a whole column value; null if a marker or padding is wrong."""
    wide = 2 * GROUP

    def value(text: Column) -> Column:
        body = F.regexp_replace(text.substr(F.lit(1), F.length(text) - 2), f"(.{{{wide}}}){PAD_MARK:02X}", "$1")
        padding = PAD_MARK - F.conv(F.substring(text, -2, 2), 16, 10).cast("int")
        return F.when(text.rlike(ENCODED), F.unhex(body.substr(F.lit(1), (F.length(text) / (wide + 2)).cast("int") * wide - 2 * padding)))

    return _let(F.hex(encoded), value)


def encode_uint(v: Column) -> Column:
    """Eight bytes, big-endian."""
    return F.unhex(F.lpad(F.hex(v.cast("long")), 16, "0"))


def encode_int(v: Column) -> Column:
    """As ``encode_uint`` with the sign bit flipped, so that byte order is number order."""
    return encode_uint(v.cast("long").bitwiseXOR(F.lit(SIGN)))


def encode_uint_desc(v: Column) -> Column:
    return encode_uint(F.bitwise_not(v.cast("long")))


def encode_int_desc(v: Column) -> Column:
    return encode_int(F.bitwise_not(v.cast("long")))


def decode_uint(b: Column) -> Column:
    """First eight bytes as a long (its bits are the unsigned value's); null if shorter."""
    high, low = (F.conv(F.hex(F.substring(b, k, 4)), 16, 10).cast("long") for k in (1, 5))
    return F.when(F.octet_length(b) >= 8, F.shiftleft(high, 32).bitwiseOR(low))


def decode_int(b: Column) -> Column:
    return decode_uint(b).bitwiseXOR(F.lit(SIGN))


def decode_uint_desc(b: Column) -> Column:
    return F.bitwise_not(decode_uint(b))


def decode_int_desc(b: Column) -> Column:
    return F.bitwise_not(decode_int(b))


def _shift(v: Column, bits: Column) -> Column:
    return F.call_function("shiftrightunsigned", v, bits)


def _significant(v: Column, width: int) -> Column:
    """How many ``width``-bit digits the unsigned value has, at least one."""
    return F.ceil(F.length(F.bin(v)) / width).cast("int")


#: Most bytes of a varint of 64 bits.
MOST_BYTES = 10


def encode_uvarint(v: Column) -> Column:
    """Seven bits a byte, lowest first, the high bit set on all but the last."""

    def code(x: Column) -> Column:
        left = [_shift(x, F.lit(7 * k)) for k in range(MOST_BYTES)]
        more = [*(rest != 0 for rest in left[1:]), F.lit(False)]
        byte = [F.lpad(F.hex(rest.bitwiseAND(F.lit(127)) + F.when(m, 128).otherwise(0)), 2, "0") for rest, m in zip(left, more, strict=True)]
        return F.unhex(F.concat(byte[0], *[F.when(m, b).otherwise("") for m, b in zip(more, byte[1:], strict=False)]))

    return _let(v.cast("long"), code)


def encode_varint(v: Column) -> Column:
    """Zig-zag, then ``encode_uvarint``."""
    return encode_uvarint(F.shiftleft(v, 1).bitwiseXOR(F.shiftright(v, 63)))


def decode_uvarint(b: Column) -> Column:
    """Value of a varint at the start; null if it does not end within ten bytes."""

    def value(text: Column) -> Column:
        total = F.lit(0).cast("long")
        for k in range(MOST_BYTES):
            low = F.conv(F.substring(text, 2 * k + 1, 2), 16, 10).cast("long").bitwiseAND(F.lit(127))
            total = total.bitwiseOR(F.when(F.length(text) > 2 * k, F.shiftleft(low, 7 * k)).otherwise(0))
        return F.when(text != "", total)

    return _let(F.regexp_extract(F.hex(b), f"^(?:[89A-F].){{0,{MOST_BYTES - 1}}}[0-7].", 0), value)


def decode_varint(b: Column) -> Column:
    return _let(decode_uvarint(b), lambda u: F.shiftrightunsigned(u, 1).bitwiseXOR(-u.bitwiseAND(F.lit(1))))


def _bytes_needed(v: Column) -> Column:
    return _significant(v, 8)


def _low_bytes(v: Column, n: Column) -> Column:
    return F.substring(F.lpad(F.hex(v), 16, "0"), 17 - n * 2, n * 2)


#: Tags below and above hold a length, those between the small values themselves.
NEGATIVE_TAG, POSITIVE_TAG, SMALL = 8, 0xFF - 8, 0xFF - 16


def encode_comparable_uvarint(v: Column) -> Column:
    """Small values in one byte, others as a length tag and their big-endian bytes; byte order is number order."""

    def code(x: Column) -> Column:
        large = _let(_bytes_needed(x), lambda n: F.concat(F.hex((POSITIVE_TAG + n).cast("long")), _low_bytes(x, n)))
        return F.unhex(F.when((x >= 0) & (x <= SMALL), F.lpad(F.hex(x + NEGATIVE_TAG), 2, "0")).otherwise(large))

    return _let(v, code)


def encode_comparable_varint(v: Column) -> Column:
    """Negative values as a falling length tag and the low bytes, others like ``encode_comparable_uvarint``."""

    def code(x: Column) -> Column:
        negative = _let(_bytes_needed(F.bitwise_not(x)), lambda n: F.concat(F.lpad(F.hex((NEGATIVE_TAG - n).cast("long")), 2, "0"), _low_bytes(x, n)))
        return F.when(x < 0, F.unhex(negative)).otherwise(encode_comparable_uvarint(x))

    return _let(v, code)


def decode_comparable_varint(b: Column) -> Column:
    def value(text: Column, tag: Column) -> Column:
        n = F.when(tag < NEGATIVE_TAG, NEGATIVE_TAG - tag).when(tag > POSITIVE_TAG, tag - POSITIVE_TAG).otherwise(0)
        filled = F.lpad(F.substring(text, F.lit(3), n * 2), 16, F.when(tag < NEGATIVE_TAG, "F").otherwise("0"))
        return F.when(F.length(text) > n * 2, F.when(n == 0, (tag - NEGATIVE_TAG).cast("long")).otherwise(_let(F.unhex(filled), decode_uint)))

    return _let(F.hex(b), lambda text: _let(F.conv(F.substring(text, 1, 2), 16, 10).cast("int"), lambda tag: value(text, tag)))


def decode_comparable_uvarint(b: Column) -> Column:
    return _let(b, lambda x: F.when(F.conv(F.hex(F.substring(x, 1, 1)), 16, 10).cast("int") >= NEGATIVE_TAG, decode_comparable_varint(x)))


def keyspace_prefix(keyspace: int, mode: int = TXN_MODE) -> bytes:
    if not 0 <= keyspace < 1 << 24:
        raise ValueError(f"a keyspace id has 24 bits: {keyspace}")
    return bytes([mode]) + keyspace.to_bytes(3, "big")


def encode_key(key: Column, keyspace: int, mode: int = TXN_MODE) -> Column:
    return F.concat(F.lit(keyspace_prefix(keyspace, mode)), key)


def decode_key(key: Column, keyspace: int, mode: int = TXN_MODE) -> Column:
    """The key without its prefix; null if it lies in another keyspace."""
    return _let(key, lambda k: F.when(F.substring(k, 1, 4) == F.lit(keyspace_prefix(keyspace, mode)), F.substring(k, F.lit(5), F.octet_length(k))))


def encode_range(lo: bytes, hi: bytes, keyspace: int, mode: int = TXN_MODE) -> tuple[bytes, bytes]:
    """Bounds within the keyspace; an open end becomes the next keyspace's start."""
    prefix = keyspace_prefix(keyspace, mode)
    after = (int.from_bytes(prefix, "big") + 1).to_bytes(4, "big")
    return prefix + lo, prefix + hi if hi else after


def decode_range(lo: Column, hi: Column, keyspace: int, mode: int = TXN_MODE) -> tuple[Column, Column]:
    """An encoded range clipped to the keyspace, without prefixes; empty is open, null where they do not meet."""
    start, end = (F.lit(x) for x in encode_range(b"", b"", keyspace, mode))
    outside = (lo >= end) | ((hi != F.lit(b"")) & (hi <= start))
    cut = lambda k: F.substring(k, F.lit(5), F.octet_length(k))
    return F.when(~outside, F.when(lo <= start, F.lit(b"")).otherwise(cut(lo))), F.when(~outside, F.when((hi == F.lit(b"")) | (hi >= end), F.lit(b"")).otherwise(cut(hi)))


def encode_region_key(key: Column, keyspace: int, mode: int = TXN_MODE) -> Column:
    """The form in which region borders are kept: keyspace prefix first, then memcomparable."""
    return encode_bytes(encode_key(key, keyspace, mode))


def decode_region_key(encoded: Column, keyspace: int, mode: int = TXN_MODE) -> Column:
    return decode_key(decode_bytes(encoded), keyspace, mode)


def decode_bucket_keys(borders: Column, keyspace: int, mode: int = TXN_MODE) -> Column:
    """An array of encoded bucket borders as borders within the keyspace.

    A first border before the keyspace and a last one after it become empty (open); others outside are left out, as is
    the keyspace's own start after an open first border.  A border that cannot be decoded makes the result null.
    """
    start, end = (F.lit(x) for x in encode_range(b"", b"", keyspace, mode))

    def place(k: Column, i: Column, n: Column) -> Column:
        return (
            F.when((i == 0) & (k < start), F.lit(b""))
            .when((i == n - 1) & ((F.octet_length(k) == 0) | (k >= end)), F.lit(b""))
            .when(F.substring(k, 1, 4) == start, F.substring(k, F.lit(5), F.octet_length(k)))
        )

    def within(plain: Column) -> Column:
        # As structs, whose place in the array is known when some are left out.
        placed = _let(F.size(plain), lambda n: F.transform(plain, lambda k, i: F.struct(place(k, i, n).alias("k"), i.alias("i"), (k == start).alias("first"))))
        return F.when(F.forall(plain, lambda k: k.isNotNull()), _let(placed, inner))

    def inner(placed: Column) -> Column:
        opened = lambda open_first: F.filter(placed, lambda x: x["k"].isNotNull() & ~(open_first & (F.octet_length(x["k"]) == 0) & (x["i"] > 0) & x["first"]))
        return F.transform(_let(F.octet_length(F.get(placed, F.lit(0))["k"]) == 0, opened), lambda x: x["k"])

    return _let(F.transform(borders, lambda k: F.when(F.octet_length(k) > 0, decode_bytes(k)).otherwise(F.lit(b""))), within)


def keyspace_id(key: Column) -> Column:
    return F.when(F.octet_length(key) >= 4, F.conv(F.hex(F.substring(key, 2, 3)), 16, 10).cast("int"))


def split_key(key: Column, keyspaces: bool) -> Column:
    """(prefix, key): the prefix is empty without keyspaces."""
    if not keyspaces:
        return F.struct(F.lit(b"").alias("prefix"), key.alias("key"))
    return F.struct(F.substring(key, 1, 4).alias("prefix"), F.substring(key, F.lit(5), F.octet_length(key)).alias("key"))


#: Names of the powers of 1024.
UNITS = ["Bytes", "KB", "MB", "GB"]


def _plain(x: Column) -> Column:
    """A double without trailing zeros."""
    return F.regexp_replace(F.regexp_replace(F.format_string("%.9f", x), "0+$", ""), r"\.$", "")


def format_bytes(n: Column) -> Column:
    """A number of bytes for people, in the largest unit that it exceeds: whole multiples bare, two digits after the
    point below 10 units, else one; halves go to the even digit."""
    out = F.concat(n.cast("string"), F.lit(" Bytes"))
    for k, unit in enumerate(UNITS[1:], 1):
        size = 1 << 10 * k
        x = n / F.lit(float(size))
        shown = F.when(n % size == 0, (n / size).cast("long").cast("string")).when(x < 10, F.format_string("%.2f", F.bround(x, 2))).otherwise(F.format_string("%.1f", F.bround(x, 1)))
        out = F.when(n > size, F.concat(shown, F.lit(f" {unit}"))).otherwise(out)
    return out


def format_duration(nanos: Column) -> Column:
    """A duration in nanoseconds for people: pruned to two digits after the point of its unit, one from 10 units on, and
    without trailing zeros; from a minute on as hours, minutes and seconds."""
    unit = F.when(nanos >= 10**9, F.lit(10**9)).when(nanos >= 10**6, F.lit(10**6)).otherwise(F.lit(10**3)).cast("long")
    rest = (nanos % unit) / unit.cast("double")
    rest = F.when(nanos < unit * 10, F.floor(rest * 100 + 0.5) / 100).otherwise(F.floor(rest * 10 + 0.5) / 10)
    kept = F.when(nanos <= 1000, nanos).otherwise(nanos - nanos % unit + F.floor(rest * unit + F.lit(1e-3)).cast("long"))
    small = F.when(kept < 10**3, F.concat(kept.cast("string"), F.lit("ns"))).when(kept < 10**6, F.concat(_plain(kept / 1e3), F.lit("µs"))).otherwise(F.concat(_plain(kept / 1e6), F.lit("ms")))
    seconds = F.concat(_plain((kept % (60 * 10**9)) / 1e9), F.lit("s"))
    minutes = (kept / (60 * 10**9)).cast("long")
    large = F.concat(
        F.when(minutes >= 60, F.concat((minutes / 60).cast("long").cast("string"), F.lit("h"))).otherwise(F.lit("")),
        F.when(minutes >= 1, F.concat((minutes % 60).cast("string"), F.lit("m"))).otherwise(F.lit("")), seconds,
    )
    return F.when(kept == 0, F.lit("0s")).when(kept < 10**9, small).otherwise(large)
