"""File systems as tasks open them, with the settings that the cluster has for Spark.

Spark opens a path through Hadoop, whose settings name end points and credentials; a task of ours opens it through Arrow.
The settings of the stores are read once on the driver, travel with the tasks, and are turned into the arguments of Arrow's file
systems. A scheme that none of them knows is an error before any job.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from tidemark.errors import TidemarkError

# Beginnings of the names of settings that say how a store is opened, and those that hold secrets.
PREFIXES = ("fs.s3a.", "fs.s3n.", "fs.azure.", "fs.gs.")
SECRETS = ("fs.s3a.access.key", "fs.s3a.secret.key", "fs.s3a.session.token")
_DBFS_MOUNT = "/dbfs"
_TRUE = "true"


class UnknownStore(TidemarkError, OSError):
    """No file system is known for a scheme."""


def _parted(uri: str) -> tuple[str, str, str]:
    """Scheme, authority and path of a URI; a plain path is one of files."""
    if "://" not in uri and not uri.startswith(("file:", "dbfs:")):
        return "file", "", uri
    scheme, _, rest = uri.partition(":")
    authority, _, path = rest[2:].partition("/") if rest.startswith("//") else ("", "", rest.lstrip("/"))
    return scheme.lower(), authority, f"/{path}"


def _given(**arguments) -> dict:
    """The arguments that have a value."""
    return {name: value for name, value in arguments.items() if value not in (None, "")}


def _address(value: str | None) -> tuple[str | None, str | None]:
    """Scheme and rest of an end point that may be written with or without a scheme."""
    if not value:
        return None, None
    scheme, found, rest = value.partition("://")
    return (scheme, rest.rstrip("/")) if found else (None, value.rstrip("/"))


def s3_arguments(bucket: str, settings: Mapping[str, str]) -> dict:
    """What ``S3FileSystem`` needs for a bucket; settings of the bucket come before those of all."""

    def of(name: str) -> str | None:
        return settings.get(f"fs.s3a.bucket.{bucket}.{name}") or settings.get(f"fs.s3a.{name}")

    scheme, endpoint = _address(of("endpoint"))
    if scheme is None and of("connection.ssl.enabled"):
        scheme = "https" if of("connection.ssl.enabled").lower() == _TRUE else "http"
    found = _given(
        access_key=of("access.key") or settings.get("fs.s3n.awsAccessKeyId"),
        secret_key=of("secret.key") or settings.get("fs.s3n.awsSecretAccessKey"),
        session_token=of("session.token"),
        region=of("endpoint.region"),
        endpoint_override=endpoint,
        scheme=scheme,
        role_arn=of("assumed.role.arn"),
        session_name=of("assumed.role.session.name"),
    )
    if "Anonymous" in (of("aws.credentials.provider") or ""):
        found = {k: v for k, v in found.items() if k not in ("access_key", "secret_key", "session_token")} | {"anonymous": True}
    if endpoint and (of("path.style.access") or "").lower() != _TRUE:
        found["force_virtual_addressing"] = True
    if of("proxy.host"):
        port = int(of("proxy.port") or 80)
        found["proxy_options"] = _given(
            scheme="http", host=of("proxy.host"), port=port, username=of("proxy.username"), password=of("proxy.password")
        )
    return found


def azure_arguments(host: str, settings: Mapping[str, str]) -> dict:
    """What ``AzureFileSystem`` needs for the host of an account, as ``account.dfs.core.windows.net``."""
    account, _, domain = host.partition(".")
    hosts = {host, f"{account}.dfs.core.windows.net", f"{account}.blob.core.windows.net"}

    def of(name: str) -> str | None:
        return next((v for h in sorted(hosts) if (v := settings.get(f"fs.azure.{name}.{h}"))), settings.get(f"fs.azure.{name}"))

    endpoint = of("account.oauth2.client.endpoint") or ""
    found = _given(
        account_name=account,
        account_key=of("account.key"),
        sas_token=of("sas.fixed.token"),
        client_id=of("account.oauth2.client.id"),
        client_secret=of("account.oauth2.client.secret"),
        tenant_id=endpoint.removeprefix("https://").partition("/")[2].partition("/")[0],
    )
    service = domain.partition(".")[2]
    if service and service != "core.windows.net":  # another cloud
        found |= {"blob_storage_authority": f".blob.{service}", "dfs_storage_authority": f".dfs.{service}"}
    return found


def gcs_arguments(bucket: str, settings: Mapping[str, str]) -> dict:
    scheme, endpoint = _address(settings.get("fs.gs.storage.root.url"))
    found = _given(scheme=scheme, endpoint_override=endpoint, project_id=settings.get("fs.gs.project.id"))
    if settings.get("fs.gs.auth.type", "").upper() == "UNAUTHENTICATED":
        found["anonymous"] = True
    return found


def _open_s3(authority: str, settings: Mapping[str, str]):
    from pyarrow import fs

    return fs.S3FileSystem(**s3_arguments(authority, settings)), authority


def _open_azure(authority: str, settings: Mapping[str, str]):
    from pyarrow import fs

    container, _, host = authority.partition("@")
    return fs.AzureFileSystem(**azure_arguments(host, settings)), container


def _open_gcs(authority: str, settings: Mapping[str, str]):
    from pyarrow import fs

    return fs.GcsFileSystem(**gcs_arguments(authority, settings)), authority


def _open_files(mount: str) -> Callable:
    def opened(authority: str, settings: Mapping[str, str]):
        from pyarrow import fs

        return fs.LocalFileSystem(), mount

    return opened


def _open_hadoop(scheme: str) -> Callable:
    def opened(authority: str, settings: Mapping[str, str]):
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(f"{scheme}://{authority}/")
        return system, base.rstrip("/")

    return opened


# How each scheme is opened, by what stands behind it.
_OPENERS: dict[str, Callable] = {
    "file": _open_files(""),
    "dbfs": _open_files(_DBFS_MOUNT),
    **dict.fromkeys(("s3", "s3a", "s3n"), _open_s3),
    **dict.fromkeys(("abfs", "abfss", "wasb", "wasbs"), _open_azure),
    **dict.fromkeys(("gs", "gcs"), _open_gcs),
    **{scheme: _open_hadoop(scheme) for scheme in ("hdfs", "viewfs")},
}


@dataclass(frozen=True)
class Stores:
    """The settings of all stores; travels to the tasks and opens a file system once per scheme and authority there."""

    settings: dict[str, str] = field(default_factory=dict, repr=False)  # with secrets
    _opened: dict = field(default_factory=dict, repr=False, compare=False)

    def __getstate__(self) -> dict:
        return {"settings": self.settings}

    def __setstate__(self, state: dict) -> None:
        object.__setattr__(self, "settings", state["settings"])
        object.__setattr__(self, "_opened", {})

    def located(self, uri: str):
        """File system of a URI, and the path in it."""
        scheme, authority, path = _parted(uri)
        require_known(scheme)
        if (scheme, authority) not in self._opened:
            self._opened[scheme, authority] = _OPENERS[scheme](authority, self.settings)
        system, base = self._opened[scheme, authority]
        return system, f"{base}{path}"

    def is_local(self, uri: str) -> bool:
        """Whether the operating system itself can open it."""
        return _parted(uri)[0] in ("file", "dbfs")


def require_known(scheme: str) -> None:
    if scheme not in _OPENERS:
        raise UnknownStore(f"No file system for {scheme}:// is known to tasks; known are {', '.join(sorted(_OPENERS))}.")


def stores_of(spark: SparkSession) -> Stores:
    """The settings of the cluster's stores; secrets may stand in Hadoop's credential providers."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    settings = {f"{prefix}{name}": value for prefix in PREFIXES for name, value in dict(hadoop.getPropsWithPrefix(prefix)).items()}
    for name in SECRETS:
        if name not in settings and (secret := hadoop.getPassword(name)) is not None:
            settings[name] = "".join(map(str, secret))
    return Stores(settings)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme that the cluster's default file system gives it; its scheme must be known to tasks."""
    scheme = folder.partition(":")[0] if ":" in folder.partition("/")[0] else None
    if scheme:
        require_known(scheme.lower())
    if scheme and scheme.lower() not in ("file", "hdfs", "viewfs"):  # what Spark need not be able to open
        return folder.rstrip("/")
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = system.makeQualified(path).toString().rstrip("/")
    require_known(_parted(found)[0])
    return found
