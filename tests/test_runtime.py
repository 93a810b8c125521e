from quillspark.runtime import Stash, clean_shared


def test_old_tables_are_cleaned(spark):
    kept = Stash(spark, "kept").put(spark.range(3))
    assert not any("/kept-" in p for p in clean_shared(spark, 1)) and kept.count() == 3
    stash = Stash(spark, "gone")
    stash.put(spark.range(3))
    assert any(p.endswith(stash.base.rpartition("/")[2]) for p in clean_shared(spark, -1))
    assert clean_shared(spark, -1) == []
