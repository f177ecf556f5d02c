import pytest

from millrace.session import move_files, path_exists, put_text, remove_path, scratch_dir, written


def test_small_files_in_any_store(spark, tmp_path):
    for place in (str(tmp_path / "a"), f"file:{tmp_path}/b"):
        put_text(spark, f"{place}/note.txt", "ü")
        put_text(spark, f"{place}/_SUCCESS", "")
        assert path_exists(spark, f"{place}/note.txt") and not path_exists(spark, f"{place}/other")
        put_text(spark, f"{place}2/first.txt", "")
        move_files(spark, place, f"{place}2")
        move_files(spark, place, f"{place}2")  # nothing is left to move
        assert path_exists(spark, f"{place}2/note.txt") and path_exists(spark, f"{place}/_SUCCESS")
        remove_path(spark, place)
        remove_path(spark, place)
        assert not path_exists(spark, place)
    assert (tmp_path / "a2" / "note.txt").read_text(encoding="utf-8") == "ü"


def test_scratch_is_shared_and_fresh(spark, tmp_path):
    parent = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(f"{parent}/millrace/x-") and scratch_dir(spark, "x") != scratch_dir(spark, "x")
    df = spark.range(3)
    assert written(df, "three").count() == 3
    assert written(df, str(tmp_path / "w")).count() == 3 and (tmp_path / "w").is_dir()


class Settings:
    def __init__(self, **values):
        self.values = {k.replace("__", "."): v for k, v in values.items()}
        self.conf = self

    def get(self, name, default=None):
        return self.values.get(name, default)


def test_no_folder_of_the_drivers_machine_on_a_cluster():
    warehouse = {"spark__sql__warehouse__dir": "file:/tmp/warehouse"}
    assert scratch_dir(Settings(spark__master="local[8]", **warehouse), "x").startswith("file:/tmp/warehouse/millrace/x-")
    with pytest.raises(ValueError, match="checkpoint"):
        scratch_dir(Settings(spark__master="yarn", **warehouse), "x")
    shared = {"spark__sql__warehouse__dir": "s3a://bucket/warehouse"}
    assert scratch_dir(Settings(spark__master="yarn", **shared), "x").startswith("s3a://bucket/warehouse/millrace/x-")
    given = {"spark__checkpoint__dir": "/shared/checkpoints"}
    assert scratch_dir(Settings(spark__master="yarn", **given, **warehouse), "x").startswith("/shared/checkpoints/millrace/x-")
