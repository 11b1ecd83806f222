"""Stores that several writers share: what is written becomes visible by one record, and a name has one record.

Data goes to a folder of its own first. Its record is then published under a name that must not exist: by a hard link on a local disk, by
a rename elsewhere (object stores need a rename that fails where the target exists). Readers look at records only, so that nothing half
written counts; a writer that is lost leaves a folder that nothing names.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def fresh_folder(store: str, kind: str) -> str:
    return f"{store}/{kind}/{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _file_system(spark, path)
    fs.delete(at, True)


def _record_path(store: str, name: str) -> str:
    if not re.fullmatch(r"[\w .-]{1,200}", name) or name.startswith((".", "_")):
        raise ValueError(f"{name!r} is no name: letters, digits, blanks, dots, hyphens and underscores")
    return f"{store}/records/{name}.json"


def publish(spark: SparkSession, store: str, name: str, record: dict) -> bool:
    """Make a record visible under a name; False, with nothing changed, if the name has one."""
    target, fs = _file_system(spark, _record_path(store, name))
    fs.mkdirs(target.getParent())
    temporary, _ = _file_system(spark, f"{store}/records/_{uuid.uuid4().hex}")
    out = fs.create(temporary, True)
    out.write(bytearray(json.dumps({"name": name, **record}).encode()))
    out.close()
    try:
        if fs.getScheme() != "file":
            return bool(fs.rename(temporary, target))
        files, uri = spark._jvm.java.nio.file.Files, spark._jvm.java.nio.file.Paths
        try:
            files.createLink(uri.get(target.toUri().getPath(), spark.sparkContext._gateway.new_array(spark._jvm.String, 0)), uri.get(temporary.toUri().getPath(), spark.sparkContext._gateway.new_array(spark._jvm.String, 0)))
        except Exception as e:  # Py4J wraps the JVM's error
            if "FileAlreadyExistsException" in str(e):
                return False
            raise
        return True
    finally:
        fs.delete(temporary, False)


def has(spark: SparkSession, store: str, name: str) -> bool:
    at, fs = _file_system(spark, _record_path(store, name))
    return fs.exists(at)


def records(spark: SparkSession, store: str, schema: str) -> DataFrame:
    """All records (name and the fields of the schema)."""
    at, fs = _file_system(spark, f"{store}/records")
    fs.mkdirs(at)
    return spark.read.schema(f"name string, {schema}").json(f"{store}/records")
