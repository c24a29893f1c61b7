"""Registered queries of the training-text operators, and comparison SQL where SQL can state the result."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import pitwall
from pitwall.llm import chat_tools, decontaminate, fingerprints, language_id, licenses, merkle, mixing, near_dedup, repeats, token_counts, token_files, toxicity, whitening
from pitwall.session import configure
from pitwall.sources.scratch import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


#: Rows of an Arrow batch. A batch of texts is held several times over on its way to Python and back, and texts are far longer than other rows.
BATCH_ROWS = 1000


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, unless they find it by themselves: through PYTHONPATH or the working folder."""
    package = Path(pitwall.__file__).resolve().parent
    known = [Path.cwd(), *map(Path, filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep)))]
    if spark.sparkContext.applicationId in _SHIPPED or package.parent in [p.resolve() for p in known]:
        return
    archive = Path(tempfile.mkdtemp(prefix="pitwall-")) / "pitwall.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(spark.sparkContext.applicationId)


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings these operators rely on, its workers with the package."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    ship_package(spark)
    return spark


def _query(name: str, sql: str | None = None):
    def wrap(build):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepared(spark)
            return build(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return wrap


@_query("op2_simhash_near_dedup")
def _(table):
    return near_dedup.digest(table("documents"), shingle=4, radius=4)


def vocabulary() -> str:
    """The tokenizer file of the queries; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_digest(docs: DataFrame) -> DataFrame:
    """Write the documents as token files under the shared folder and describe each from what the files hold."""
    root = scratch_path(docs.sparkSession, "token-files")
    token_files.write(docs, root, vocabulary(), end_id=2)
    return token_files.documents(docs.sparkSession, root)


@_query("op10_token_files")
def _(table):
    return token_digest(table("documents"))


@_query("op7_source_mixing", mixing.ORACLE)
def _(table):
    return mixing.digest(table("documents"))


@_query("op6_decontaminate", decontaminate.ORACLE)
def _(table):
    return decontaminate.digest(table("documents"), table("benchmark"))


@_query("op9_toxicity")
def _(table):
    return toxicity.digest(table("documents"), table("labels"))


@_query("op1_language_id")
def _(table):
    return language_id.digest(table("documents"))


@_query("op5_fingerprints")
def _(table):
    return fingerprints.digest(table("documents"))


@_query("op8_license_scan")
def _(table):
    return licenses.digest(table("documents"))


@_query("op4_token_counts")
def _(table):
    return token_counts.digest(table("documents"), vocabulary())


@_query("op3_tool_call_linking")
def _(table):
    return chat_tools.digest(table("conversations"))


@_query("op11_repeated_passages", repeats.ORACLE)
def _(table):
    return repeats.digest(table("documents"))


@_query("op12_merkle_manifest")
def _(table):
    return merkle.digest(table("documents"))


@_query("op13_embedding_whitening")
def _(table):
    return whitening.whitened(table("embeddings"))
