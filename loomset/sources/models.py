"""Models written in code, IR documents as JSON, lists of known classes, and provider settings."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..frames import written
from ..functions.names import strip
from ..plans.model import Model, nested

REF = "STRUCT<package: STRING, class_name: STRING, iri: STRING, is_external: BOOLEAN>"
MULT = "STRUCT<min: INT, max: INT, raw: STRING>"
ATTRIBUTE = f"STRUCT<name: STRING, data_type: STRING, multiplicity: {MULT}, description: STRING, required: BOOLEAN>"
ASSOCIATION = f"STRUCT<name: STRING, target: {REF}, multiplicity: {MULT}, inverse_name: STRING>"
CLASS = f"STRUCT<name: STRING, description: STRING, stereotype: STRING, parents: ARRAY<{REF}>, attributes: ARRAY<{ATTRIBUTE}>, associations: ARRAY<{ASSOCIATION}>, source_table: INT>"
PACKAGES = f"ARRAY<STRUCT<iri: STRING, name: STRING, package_id: STRING, version: STRING, classes: ARRAY<{CLASS}>, enumerations: ARRAY<STRUCT<name: STRING, values: ARRAY<STRING>>>>>"


def multiplicity(text: str) -> dict:
    """``a..b`` or ``a..*``; anything else is an error."""
    if not (m := re.fullmatch(r"(\d+)\.\.(\d+|\*)", text)):
        raise ValueError(f"no multiplicity: {text!r}")
    return {"min": int(m[1]), "max": None if m[2] == "*" else int(m[2]), "raw": text}


def attr(name: str, data_type: str = "xsd:string", mult: str | None = None, required: bool = False, description: str | None = None) -> dict:
    return {"name": name, "data_type": data_type, "multiplicity": multiplicity(mult or ("1..1" if required else "0..1")), "description": description, "required": required}


def cref(package: str, class_name: str | None, iri: str | None = None, is_external: bool = False) -> dict:
    return {"package": package, "class_name": class_name, "iri": iri, "is_external": is_external}


def assoc(name: str, package: str, class_name: str, mult: str = "0..*", inverse_name: str | None = None) -> dict:
    return {"name": name, "target": cref(package, class_name), "multiplicity": multiplicity(mult), "inverse_name": inverse_name}


def cls(name: str, description: str | None = None, parents: list[dict] | None = None, attributes: list[dict] | None = None, associations: list[dict] | None = None, stereotype: str | None = None) -> dict:
    return {"name": name, "description": description, "stereotype": stereotype, "parents": parents or [], "attributes": attributes or [], "associations": associations or [], "source_table": None}


@dataclass
class PackageSource:
    """A package written in code."""

    name: str
    iri: str
    classes: list[dict]
    package_id: str | None = None
    version: str = "0.1.0"
    enumerations: dict[str, list[str]] = field(default_factory=dict)

    def row(self) -> dict:
        return {"iri": self.iri, "name": self.name, "package_id": self.package_id, "version": self.version, "classes": self.classes, "enumerations": [{"name": k, "values": v} for k, v in self.enumerations.items()]}


def from_code(spark: SparkSession, packages: list[PackageSource], doc_id: int = 0) -> Model:
    """The model of packages written in code."""
    return nested(spark.createDataFrame([{"ir_id": doc_id, "packages": [p.row() for p in packages]}], f"ir_id BIGINT, packages {PACKAGES}"))


def _read(spark: SparkSession, path: str, mode: str) -> DataFrame:
    return spark.read.schema(f"schema_version STRING, packages {PACKAGES}, _unread STRING").option("multiLine", True).option("columnNameOfCorruptRecord", "_unread").json(path, mode=mode)


def ir_documents(spark: SparkSession, path: str, strict: bool = True) -> Model:
    """The model of IR documents in JSON, one a file; the id is a hash of the path. A file that isn't of the schema raises an error; if not
    ``strict``, it has no packages and ``unread_documents`` lists it."""
    x = _read(spark, path, "FAILFAST" if strict else "PERMISSIVE")
    return nested(x.select(F.xxhash64(F.input_file_name()).alias("ir_id"), F.when(F.col("_unread").isNull(), F.col("packages")).alias("packages")))


def unread_documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of the files under ``path`` that are not of the schema."""
    x = written(_read(spark, path, "PERMISSIVE").select(F.input_file_name().alias("path"), F.size("packages").alias("n"), F.col("_unread").alias("text")))
    return x.where("text is not null").select("path", "text")


def known_classes(spark: SparkSession, path: str) -> DataFrame:
    """(name) of a list with one name a line, in the order of the list, blank lines and those that begin with ``#`` left out, each name once. A missing
    file is an error."""
    x = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.posexplode(F.split("value", "\r?\n")).alias("at", "line"))
    x = x.select("file", "at", strip(F.col("line")).alias("name")).where("name <> '' and not startswith(name, '#')")
    return x.groupBy("name").agg(F.min(F.struct("file", "at")).alias("at")).orderBy("at").select("name")


def ir_json(m: Model) -> DataFrame:
    """(doc_id, content): the model as IR documents in JSON, as ``ir_documents`` reads them: packages and their lists in order."""
    by_class = lambda t, at, *cols: t.groupBy("doc_id", "pkg_ord", "cls_ord").agg(F.transform(F.array_sort(F.collect_list(F.struct(at, F.struct(*cols).alias("v")))), lambda x: x["v"]).alias("v"))
    key = ["doc_id", "pkg_ord", "cls_ord"]
    parts = (("parents", by_class(m.parent, "par_ord", "package", "class_name", "iri", "is_external")), ("attributes", by_class(m.attribute, "attr_ord", "name", "data_type", "multiplicity", "description", "required", "inherited_from")), ("associations", by_class(m.association, "assoc_ord", "name", "target", "multiplicity", "inverse_name", "inherited_from")))
    c = m.classes
    for name, t in parts:
        c = c.join(t.withColumnRenamed("v", name), key, "left").withColumn(name, F.coalesce(name, F.array()))
    of = lambda t, at, body, name: t.groupBy("doc_id", "pkg_ord").agg(F.transform(F.array_sort(F.collect_list(F.struct(at, F.struct(*body).alias("v")))), lambda x: x["v"]).alias(name))
    classes = of(c, "cls_ord", ["name", "description", "stereotype", "parents", "attributes", "associations", "source_table"], "classes")
    enums = of(m.enumeration, "enum_ord", ["name", "values"], "enumerations")
    p = m.package.join(classes, ["doc_id", "pkg_ord"], "left").join(enums, ["doc_id", "pkg_ord"], "left")
    p = p.withColumn("classes", F.coalesce("classes", F.array())).withColumn("enumerations", F.coalesce("enumerations", F.array()))
    p = p.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pkg_ord", F.struct("iri", "name", "package_id", "version", "classes", "enumerations").alias("v")))), lambda x: x["v"]).alias("packages"))
    return p.select("doc_id", F.to_json(F.struct(F.lit("1.0").alias("schema_version"), "packages")).alias("content"))


def union_of_known(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("name").union(b.select("name")).distinct().orderBy("name")


def env_settings(text: str) -> dict[str, str]:
    """``KEY=VALUE`` lines; quotes around a value are taken off, comments and other lines left out."""
    out = {}
    for line in text.splitlines():
        if (m := re.fullmatch(r"\s*(?:export\s+)?([A-Za-z_]\w*)\s*=\s*(.*?)\s*", line)) and not line.lstrip().startswith("#"):
            v = m[2]
            out[m[1]] = v[1:-1] if len(v) > 1 and v[0] == v[-1] and v[0] in "\"'" else v
    return out


def provider_name(env: Mapping[str, str]) -> str:
    """Which reviewer the settings ask for: none in CI, else the first with a key, else a local one if wanted, else none."""
    if env.get("CI", "").lower() == "true":
        return "mock"
    for key, name in (("DEEPSEEK_API_KEY", "deepseek"), ("ANTHROPIC_API_KEY", "claude")):
        if env.get(key):
            return name
    return "ollama" if env.get("USE_OLLAMA", "").lower() in ("1", "true") else "mock"
