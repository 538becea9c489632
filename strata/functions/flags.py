"""Flags of buffered keys as bits of an integer column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The bit of each flag, in order.
FLAGS = [
    "presume_not_exists", "key_locked", "need_locked", "locked_value_exists", "need_check_exists", "prewrite_only", "ignored_in_2pc",
    "readable", "newly_inserted", "assert_exist", "assert_not_exist", "need_constraint_check", "previous_presume", "locked_in_share_mode",
]
BIT = {name: 1 << k for k, name in enumerate(FLAGS)}

#: What each operation sets and clears.
OPERATIONS = {
    "set_presume_not_exists": (["presume_not_exists", "need_check_exists"], []),
    "del_presume_not_exists": ([], ["presume_not_exists", "need_check_exists"]),
    "set_key_locked": (["key_locked"], []),
    "del_key_locked": ([], ["key_locked"]),
    "set_need_locked": (["need_locked"], []),
    "del_need_locked": ([], ["need_locked"]),
    "set_locked_value_exists": (["locked_value_exists"], ["need_constraint_check"]),
    "set_locked_value_not_exists": ([], ["locked_value_exists", "need_constraint_check"]),
    "del_need_check_exists": ([], ["need_check_exists"]),
    "set_prewrite_only": (["prewrite_only"], []),
    "set_ignored_in_2pc": (["ignored_in_2pc"], []),
    "set_readable": (["readable"], []),
    "set_newly_inserted": (["newly_inserted"], []),
    "set_assert_exist": (["assert_exist"], ["assert_not_exist"]),
    "set_assert_not_exist": (["assert_not_exist"], ["assert_exist"]),
    "set_assert_unknown": (["assert_exist", "assert_not_exist"], []),
    "set_assert_none": ([], ["assert_exist", "assert_not_exist"]),
    "set_need_constraint_check": (["need_constraint_check"], []),
    "del_need_constraint_check": ([], ["need_constraint_check"]),
    "set_previous_presume": (["previous_presume"], []),
    "set_locked_in_share_mode": (["locked_in_share_mode"], []),
    "set_locked_in_exclusive_mode": ([], ["locked_in_share_mode"]),
}
#: Flags that survive when a stage is discarded.
PERSISTENT = ["key_locked", "locked_value_exists", "need_constraint_check", "locked_in_share_mode"]


def mask(names: list[str]) -> int:
    return reduce(lambda a, b: a | BIT[b], names, 0)


def apply(flags: Column, operation: str) -> Column:
    on, off = OPERATIONS[operation]
    return flags.bitwiseAND(F.lit(~mask(off))).bitwiseOR(F.lit(mask(on)))


def has(flags: Column, name: str) -> Column:
    return flags.bitwiseAND(F.lit(BIT[name])) != 0


def persistent(flags: Column) -> Column:
    return flags.bitwiseAND(F.lit(mask(PERSISTENT)))
