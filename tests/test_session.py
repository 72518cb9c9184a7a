from __future__ import annotations

from fareweather.session import build_session, object_store_path, s3a_settings, scratch_folder, shared_folder


def test_object_store_paths():
    assert object_store_path("s3://bucket/key") == "s3a://bucket/key"
    assert object_store_path("s3a://bucket/key") == "s3a://bucket/key"
    assert object_store_path("/data/s3://odd") == "/data/s3://odd"


def test_object_store_settings_hold_no_keys_of_their_own():
    settings = s3a_settings(endpoint="http://store:9000", path_style=True)
    assert settings["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert settings["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert not any(key.endswith((".access.key", ".secret.key")) for key in settings)


def test_session_reads_wall_clock_in_utc(spark):
    assert build_session("again").conf.get("spark.sql.session.timeZone") == "UTC"


def test_scratch_lies_in_the_shared_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == named
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first.startswith(named) and first != second
