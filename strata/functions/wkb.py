"""What the first bytes of a WKB value say, as short built-in Column expressions.

No decoding and no Python: type, Z/M flags, part count and emptiness come from
the header and the length of the value. ISO and extended type codes, and both
byte orders, are understood: the possible headers are listed by rule, and a value's
header is looked up in that list.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# WKB type codes.
POINT, LINESTRING, POLYGON, COLLECTION = 1, 2, 3, 7
TYPE_NAMES = {1: "POINT", 2: "LINESTRING", 3: "POLYGON", 4: "MULTIPOINT",
              5: "MULTILINESTRING", 6: "MULTIPOLYGON", 7: "GEOMETRYCOLLECTION"}
# Flag bits of the extended type code.
FLAG_Z, FLAG_M, FLAG_SRID, TYPE_BITS = 0x80000000, 0x40000000, 0x20000000, 0x0FFFFFFF

KINDS = len(TYPE_NAMES)
# Ways to write a type: (added to the code, Z, M); the SRID ones come last.
PLAIN_WAYS = ((0, False, False), (1000, True, False), (2000, False, True), (3000, True, True),
              (FLAG_Z, True, False), (FLAG_M, False, True), (FLAG_Z | FLAG_M, True, True))
SRID_WAYS = tuple((FLAG_SRID | add, z, m) for add, z, m in PLAIN_WAYS if add not in (1000, 2000, 3000))
WAYS = PLAIN_WAYS + SRID_WAYS
PER_ORDER = len(WAYS) * KINDS

_HEADERS = [
    f"{mark:02X}" + (add + kind).to_bytes(4, order).hex().upper()
    for mark, order in ((1, "little"), (0, "big")) for add, _, _ in WAYS for kind in TYPE_NAMES
]

# The same headers without the SRID flag.
_BARE = [
    f"{mark:02X}" + (add + kind & ~FLAG_SRID & 0xFFFFFFFF).to_bytes(4, order).hex().upper()
    for mark, order in ((1, "little"), (0, "big")) for add, _, _ in WAYS for kind in TYPE_NAMES
]


def _list(values: list[str]) -> Column:
    """A constant array; the split is folded away by the optimizer."""
    return F.split(F.lit(",".join(values)), ",")


def _slot(c: Column) -> Column:
    """Place of the value's header in the list, from 0; -1 for an unknown header."""
    return F.array_position(_list(_HEADERS), F.hex(F.substring(c, 1, 5))) - 1


def _way(c: Column) -> Column:
    return F.floor(_slot(c) % PER_ORDER / KINDS)


def base_type(c: Column) -> Column:
    """1 to 7; 0 for an unknown header; NULL for a NULL value."""
    slot = _slot(c)
    return F.when(slot < 0, F.lit(0)).otherwise(slot % KINDS + 1).cast("int")


def has_z(c: Column) -> Column:
    return _way(c).isin(*[i for i, w in enumerate(WAYS) if w[1]])


def has_m(c: Column) -> Column:
    return _way(c).isin(*[i for i, w in enumerate(WAYS) if w[2]])


def _little(c: Column) -> Column:
    return F.substring(c, 1, 1) == F.lit(b"\x01")


def _body_start(c: Column) -> Column:
    """Position (from 1) behind the header and the SRID."""
    return F.when(_way(c) >= len(PLAIN_WAYS), F.lit(10)).otherwise(F.lit(6))


def type_name(c: Column) -> Column:
    return F.get(_list(["UNKNOWN", *TYPE_NAMES.values()]), base_type(c))


def _counted(c: Column) -> Column:
    """The number after the header of anything but a point."""
    h = F.hex(F.substring(c, _body_start(c), F.lit(4)))
    swapped = F.concat(*[F.substring(h, i, 2) for i in (7, 5, 3, 1)])
    return F.conv(F.when(_little(c), swapped).otherwise(h), 16, 10).cast("bigint")


def element_count(c: Column) -> Column:
    """Points of a line, rings of a polygon, parts of a collection; 1 for a point."""
    return F.when(base_type(c) == POINT, F.lit(1).cast("bigint")).otherwise(_counted(c))


def num_parts(c: Column) -> Column:
    return (
        F.when(c.isNull(), None).when(base_type(c) > POLYGON, _counted(c))
        .otherwise(F.lit(1).cast("bigint"))
    )


# Two coordinates that are not numbers (and not infinite), as hex text of either byte order.
_EMPTY_LITTLE = "^(?:(?!0{12}F0).{12}F.[7F]F){2}$"
_EMPTY_BIG = "^(?:(?![7F]FF0{13})[7F]FF.{13}){2}$"


def is_empty(c: Column) -> Column:
    """NULL for a NULL geometry.

    A collection or polygon of only empty members is as long as their bare headers.
    """
    xy = F.hex(F.substring(c, _body_start(c), F.lit(16)))
    point_empty = F.when(_little(c), xy.rlike(_EMPTY_LITTLE)).otherwise(xy.rlike(_EMPTY_BIG))
    kind = base_type(c)
    rest = F.length(c) - _body_start(c) - 3
    member = F.when(kind == POLYGON, F.lit(4)).otherwise(F.lit(9))
    return (
        F.when(kind == POINT, point_empty)
        .when(kind == LINESTRING, rest == 0)
        .when(kind > 0, rest == _counted(c) * member)
    )


def to_multi(c: Column) -> Column:
    """A single part becomes the one member of its multi type; others stay.

    The wrapper has the member's byte order and flags. An SRID moves to the wrapper, and the member's
    header loses its flag.
    """
    slot = _slot(c)
    wrapper = F.unhex(F.get(_list(_HEADERS), (slot % PER_ORDER + 3 + F.when(_little(c), 0).otherwise(PER_ORDER)).cast("int")))
    one = F.when(_little(c), F.lit(b"\x01\x00\x00\x00")).otherwise(F.lit(b"\x00\x00\x00\x01"))
    bare = F.unhex(F.get(_list(_BARE), slot.cast("int")))
    with_srid = F.concat(wrapper, F.substring(c, 6, 4), one, bare, F.substring(c, F.lit(10), F.length(c)))
    single = (slot >= 0) & base_type(c).between(POINT, POLYGON)
    return F.when(single & (_way(c) >= len(PLAIN_WAYS)), with_srid).when(single, F.concat(wrapper, one, c)).otherwise(c)
