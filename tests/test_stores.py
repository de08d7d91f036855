"""How paths become file systems: settings of the cluster in, arguments out; nothing is contacted."""

from __future__ import annotations

import pickle
import tracemalloc

import pyarrow as pa
import pytest

from tidemark.errors import TidemarkError
from tidemark.sources import listing, stores
from tidemark.sources.stores import Stores, azure_arguments, gcs_arguments, s3_arguments, stores_of


def test_s3_settings():
    settings = {
        "fs.s3a.access.key": "key", "fs.s3a.secret.key": "secret", "fs.s3a.session.token": "token",
        "fs.s3a.endpoint": "http://store.local:9000/", "fs.s3a.endpoint.region": "eu-west-1", "fs.s3a.path.style.access": "true",
    }
    assert s3_arguments("b", settings) == {
        "access_key": "key", "secret_key": "secret", "session_token": "token", "region": "eu-west-1",
        "endpoint_override": "store.local:9000", "scheme": "http",
    }
    own = settings | {"fs.s3a.bucket.b.access.key": "other", "fs.s3a.path.style.access": "false"}
    assert s3_arguments("b", own)["access_key"] == "other" and s3_arguments("c", own)["access_key"] == "key"
    assert s3_arguments("b", own)["force_virtual_addressing"] is True
    assert s3_arguments("b", {"fs.s3a.endpoint": "s3.x.org", "fs.s3a.connection.ssl.enabled": "false"})["scheme"] == "http"
    anonymous = {"fs.s3a.aws.credentials.provider": "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider"}
    assert s3_arguments("b", settings | anonymous)["anonymous"] and "access_key" not in s3_arguments("b", settings | anonymous)
    assert s3_arguments("b", {"fs.s3n.awsAccessKeyId": "old", "fs.s3n.awsSecretAccessKey": "s"}) == {"access_key": "old", "secret_key": "s"}
    assert s3_arguments("b", {"fs.s3a.proxy.host": "p", "fs.s3a.proxy.port": "81"})["proxy_options"] == {"scheme": "http", "host": "p", "port": 81}
    assert s3_arguments("b", {}) == {}


def test_azure_and_gcs_settings():
    host = "acc.dfs.core.windows.net"
    assert azure_arguments(host, {f"fs.azure.account.key.{host}": "k"}) == {"account_name": "acc", "account_key": "k"}
    assert azure_arguments("acc.blob.core.windows.net", {f"fs.azure.account.key.{host}": "k"})["account_key"] == "k"
    oauth = {
        "fs.azure.account.oauth2.client.id": "i", "fs.azure.account.oauth2.client.secret": "s",
        "fs.azure.account.oauth2.client.endpoint": "https://login.x.com/tenant-1/oauth2/token",
    }
    assert azure_arguments(host, oauth) == {"account_name": "acc", "client_id": "i", "client_secret": "s", "tenant_id": "tenant-1"}
    assert azure_arguments("acc.dfs.core.cloud.org", {})["dfs_storage_authority"] == ".dfs.core.cloud.org"
    assert gcs_arguments("b", {"fs.gs.auth.type": "unauthenticated", "fs.gs.storage.root.url": "http://l:1"}) == {
        "scheme": "http", "endpoint_override": "l:1", "anonymous": True,
    }


@pytest.mark.parametrize(
    ("uri", "kind", "path"),
    [
        ("s3a://bucket/a/b.xlsx", "s3", "bucket/a/b.xlsx"),
        ("s3n://bucket/a b", "s3", "bucket/a b"),
        ("S3://bucket/x", "s3", "bucket/x"),
        ("abfss://box@acc.dfs.core.windows.net/d/f", "abfs", "box/d/f"),
        ("wasbs://box@acc.blob.core.windows.net/f", "abfs", "box/f"),
        ("gs://bucket/f", "gcs", "bucket/f"),
        ("file:///d/f", "local", "/d/f"),
        ("file:/d/f", "local", "/d/f"),
        ("/d/f", "local", "/d/f"),
        ("dbfs:/d/f", "local", "/dbfs/d/f"),
    ],
)
def test_schemes(uri, kind, path):
    settings = {"fs.s3a.endpoint.region": "eu-west-1", "fs.azure.account.key.acc.dfs.core.windows.net": "a2V5", "fs.gs.auth.type": "UNAUTHENTICATED"}
    known = pickle.loads(pickle.dumps(Stores(settings)))
    system, inside = known.located(uri)
    assert (system.type_name, inside) == (kind, path)
    assert known.located(uri)[0] is system
    assert "a2V5" not in repr(known)


def test_unknown_schemes_fail_before_any_job(spark):
    with pytest.raises(TidemarkError, match="hdfs, s3, s3a"):
        listing.list_folder(spark, "ftp://host/folder")
    with pytest.raises(OSError, match="ftp://"):
        Stores().located("ftp://host/f")


def test_the_cluster_s_settings_reach_the_tasks(spark):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("fs.s3a.endpoint.region", "eu-north-1")
    hadoop.set("fs.s3a.bucket.b.endpoint", "https://own.example.org")
    try:
        found = pickle.loads(pickle.dumps(stores_of(spark)))
    finally:
        hadoop.unset("fs.s3a.endpoint.region")
        hadoop.unset("fs.s3a.bucket.b.endpoint")
    assert s3_arguments("b", found.settings)["region"] == "eu-north-1"
    assert s3_arguments("b", found.settings)["endpoint_override"] == "own.example.org"
    assert stores.qualified(spark, "s3a://b/c/") == "s3a://b/c"


def test_a_folder_of_200_000_files_is_listed_in_bounded_memory(tmp_path):
    many = 200_000
    for i in range(many):
        (tmp_path / f"operations_snapshot_{i:06d}.xlsx").touch()
    (tmp_path / "_below").mkdir()
    (tmp_path / "link.xlsx").symlink_to(tmp_path / "nothing")
    batch = pa.RecordBatch.from_arrays([pa.array([f"file:{tmp_path}"]), pa.array([""])], names=["path", "relative"])
    seen, folders = 0, 0
    tracemalloc.start()
    for found in listing.folder_lister(Stores())(iter([batch])):
        assert found.num_rows <= 4096
        seen, folders = seen + found.num_rows, folders + sum(found.column(3).to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (seen, folders) == (many + 2, 1)
    assert peak < 8 << 20
