"""Hadoop schemes as Arrow's file systems, without a network."""

from __future__ import annotations

from galley.sources.drops import streamed_files
from galley.sources.file_systems import has_folders, opened, s3_arguments, settings_of

SETTINGS = {
    "fs.s3a.access.key": "key",
    "fs.s3a.secret.key": "secret",
    "fs.s3a.endpoint": "http://store.example:9000",
    "fs.s3a.endpoint.region": "eu-west-1",
    "fs.s3a.path.style.access": "true",
}


def test_schemes(tmp_path):
    (tmp_path / "a b%c").write_text("x")
    for uri in (f"file://{tmp_path}/a%20b%25c", f"file:{tmp_path}/a%20b%25c"):
        system, path = opened(uri, {})
        assert system.open_input_stream(path).read() == b"x" and has_folders(system)
    for scheme in ("s3a", "s3n", "s3"):
        system, path = opened(f"{scheme}://bucket/drops/2024-05-03/orders.json", SETTINGS)
        assert (system.type_name, path, system.region) == ("s3", "bucket/drops/2024-05-03/orders.json", "eu-west-1")
        assert not has_folders(system)


def test_settings_become_arguments(spark):
    found = s3_arguments(SETTINGS)
    assert found == {
        "access_key": "key",
        "secret_key": "secret",
        "region": "eu-west-1",
        "endpoint_override": "store.example:9000",
        "scheme": "http",
        "force_virtual_addressing": False,
    }
    assert s3_arguments({"fs.s3a.connection.ssl.enabled": "false"}) == {"scheme": "http"}
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.s3a.endpoint.region", "eu-west-1")
    try:
        assert settings_of(spark)["fs.s3a.endpoint.region"] == "eu-west-1"
    finally:
        conf.unset("fs.s3a.endpoint.region")


def test_a_file_that_cannot_be_opened_is_one_files_error(spark, tmp_path):
    (tmp_path / "orders.json").write_text("[]")
    rows = [("orders.json", "orders.json", f"file:{tmp_path}/orders.json"), ("x.json", "x.json", "strange://there/x.json")]
    found = {r.file: r for r in streamed_files(spark.createDataFrame(rows, "file string, name string, path string")).collect()}
    assert found["orders.json"].error is None and found["orders.json"].size_bytes == 2
    assert found["x.json"].sha256 is None and found["x.json"].error
