"""Contract checks."""

import pytest

from rosterlake import layout as L
from rosterlake.errors import ContractError, ReportError
from rosterlake.operators.bronze import retained_columns
from rosterlake.operators.contracts import (
    check_snapshot_label,
    key_violations,
    require_columns,
    taxonomy_slots,
)
from tests.fixtures import SOURCE_COLUMNS, text_frame


def slots(*suffixes, switches=None):
    switches = suffixes if switches is None else switches
    return [f"{L.SLOT_CODE_PREFIX}{n}" for n in suffixes] + [
        f"{L.SLOT_SWITCH_PREFIX}{n}" for n in switches
    ]


def test_all_missing_columns_are_named():
    columns = [c for c in SOURCE_COLUMNS if c not in (L.FIRST_NAME, L.ZIP)]
    with pytest.raises(ContractError) as error:
        retained_columns(columns)
    assert L.FIRST_NAME in str(error.value) and L.ZIP in str(error.value)


def test_retained_columns_keep_source_order():
    columns = ["Other", *reversed(SOURCE_COLUMNS), "Another"]
    assert retained_columns(columns) == list(reversed(SOURCE_COLUMNS))


def test_optional_base_columns_may_be_absent():
    columns = [*L.REQUIRED_SOURCE_COLUMNS, *slots(1)]
    assert retained_columns(columns) == columns


def test_slots_sort_by_number():
    assert [s.number for s in taxonomy_slots(slots(10, 2, 1))] == [1, 2, 10]


def test_slot_without_switch():
    with pytest.raises(ContractError, match="Code_2"):
        taxonomy_slots(slots(1, 2, switches=(1,)))


def test_no_slots():
    with pytest.raises(ContractError, match="No 'Healthcare"):
        taxonomy_slots(["NPI"])


def test_suffix_that_is_no_number():
    columns = [*slots(1), f"{L.SLOT_CODE_PREFIX}x"]
    assert len(taxonomy_slots(columns)) == 1
    with pytest.raises(ContractError, match="Code_x"):
        taxonomy_slots(columns, strict=True)


def test_zero_padded_slot_pairs_with_plain_switch():
    slot = taxonomy_slots([f"{L.SLOT_CODE_PREFIX}01", f"{L.SLOT_SWITCH_PREFIX}1"])[0]
    assert (slot.number, slot.switch) == (1, f"{L.SLOT_SWITCH_PREFIX}1")


def test_require_columns():
    require_columns(["a", "b"], ["a"], "T")
    with pytest.raises(ContractError, match="T is missing required column.*: c, d"):
        require_columns(["a"], ["c", "a", "d"], "T")


@pytest.mark.parametrize("label", ["", "a b", "a/b", "é", "a\n", "../x"])
def test_bad_labels(label):
    with pytest.raises(ReportError):
        check_snapshot_label(label)


def test_good_label():
    assert check_snapshot_label("2026-01_week") == "2026-01_week"


def test_key_violations(spark):
    frame = text_frame(spark, ["npi"], [("1",), ("2",), ("2",), (None,), (None,), ("3",), ("3",)])
    assert tuple(key_violations(frame).first()) == (2, 2)
    assert tuple(key_violations(frame.limit(0)).first()) == (0, 0)
