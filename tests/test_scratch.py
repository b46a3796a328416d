"""Scratch folders go with the scope they were made in."""

import os

import pytest

from corvid.operators import windows
from corvid.session import discard, ensure_checkpoint_dir, materialise, scratch_path, scratch_scope


def _folders(spark):
    return set(os.listdir(ensure_checkpoint_dir(spark).removeprefix("file:")))


def test_scope_deletes_what_was_stored_inside(spark):
    kept = materialise(spark.range(5), "kept")
    before = _folders(spark)
    with scratch_scope(spark):
        with scratch_scope(spark):
            inner = materialise(spark.range(3), "inner")
            assert inner.count() == 3
        assert _folders(spark) == before
        rows = windows.running(spark.range(100), [], ["id"], {"s": ("sum", "id")}).collect()
        assert max(r.s for r in rows) == 4950 and _folders(spark) > before
        scratch_path(spark, "never-written")
    assert _folders(spark) == before and kept.count() == 5
    discard(kept)
    assert len(_folders(spark)) == len(before) - 1


def test_scope_ends_with_an_error(spark):
    before = _folders(spark)
    with pytest.raises(ValueError), scratch_scope(spark):
        materialise(spark.range(3), "failed")
        raise ValueError
    assert _folders(spark) == before
