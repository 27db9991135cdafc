from ledgerlens import schema as S
from ledgerlens.sources import (
    Scratch,
    preview,
    read_csv,
    read_csv_text,
    read_feature_arrays,
    read_parquet,
    write_parquet,
)
from ledgerlens.operators.scaling import text_label


def _table(spark):
    rows = [(i, float(i), *[i + j / 10 for j in range(28)], i * 1.5, i % 2) for i in range(5)]
    return spark.createDataFrame(rows, S.keyed())


def test_csv_keeps_types_and_values(spark, tmp_path):
    table = _table(spark)
    table.write.option("header", True).csv(str(tmp_path / "t"))
    back = read_csv(spark, str(tmp_path / "t"), S.keyed())
    assert back.schema == S.keyed() and sorted(back.collect()) == sorted(table.collect())
    inferred = read_csv(spark, str(tmp_path / "t"), None)
    assert dict(inferred.dtypes)["V3"] == "double"


def test_csv_as_text_and_its_label(spark, tmp_path):
    _table(spark).write.option("header", True).csv(str(tmp_path / "t"))
    text = read_csv_text(spark, str(tmp_path / "t"))
    assert set(dict(text.dtypes).values()) == {"string"}
    assert sorted(r[0] for r in text.select(text_label()).collect()) == [0, 0, 0, 1, 1]


def test_feature_arrays(spark, tmp_path):
    _table(spark).write.option("header", True).csv(str(tmp_path / "t"))
    rows = read_feature_arrays(spark, str(tmp_path / "t"), S.keyed(), "event_id").orderBy("id").collect()
    assert len(rows[2].value) == 29 and rows[2].value[0] == 2.0 and rows[2].value[28] == 3.0


def test_parquet_overwrite(spark, tmp_path):
    path = str(tmp_path / "p")
    write_parquet(spark.range(9), path)
    write_parquet(spark.range(4), path)
    assert read_parquet(spark, path).count() == 4
    assert preview(read_parquet(spark, path), 2).count() == 2


def test_scratch_lives_in_the_checkpoint_folder(spark):
    scratch = Scratch(spark, "test")
    assert scratch.root.startswith(spark.conf.get("spark.checkpoint.dir"))
    table = scratch.write(spark.range(3), "t")
    assert table.count() == 3
    scratch.drop(table)
    assert not spark._jvm.java.io.File(f"{scratch.root}/0001-t").exists()


def test_clear_keeps_what_the_result_reads(spark):
    scratch = Scratch(spark, "test")
    first, second = scratch.write(spark.range(3), "a"), scratch.write(spark.range(5), "b")
    scratch.clear(keep=second)
    assert second.count() == 5
    assert not spark._jvm.java.io.File(f"{scratch.root}/0001-a").exists()
