"""Documents to files: parse, resolve, review if asked, emit, write, read back."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import PipelineError, Severity
from ..frames import written
from ..operators import review
from ..sinks import append_cache, read_cache, write_files
from ..sources import markdown
from . import emit
from .model import Model, materialised


@dataclass
class Built:
    """What a run made: the model, its entries still uncertain, the manifest (path, bytes), files that can't be read back, counts by form."""

    model: Model
    uncertain: DataFrame
    manifest: DataFrame
    issues: DataFrame
    stats: dict[str, int] = field(default_factory=dict)


def reviewed_model(m: Model, uncertain: DataFrame, provider: review.Provider, known: DataFrame, cache: DataFrame, tries: int = review.TRIES) -> tuple[Model, DataFrame, DataFrame]:
    """The model with accepted corrections, the entries that stay uncertain, and the answers new to the cache. Case ids are those of the entries
    within their documents; in the cache they stand behind the document's id."""
    one = uncertain.withColumn("case_id", F.concat_ws("/", F.col("doc_id").cast("string"), "case_id"))
    decisions, new = review.reviewed(one, cache, provider, known, tries)
    classes = review.corrected_classes(m.classes, decisions).select(*m.classes.columns)
    return m.with_(classes=classes), review.still_uncertain(decisions, m.classes.select("name")), new


def build(spark: SparkSession, source: str, output: str, forms: list[str] | None = None, provider: review.Provider | None = None, known: DataFrame | None = None, cache: str | None = None, tries: int = review.TRIES) -> Built:
    """Runs all stages over the Markdown files of ``source``. A review takes place if there is a provider and anything is uncertain; corrections
    count only if they name a class of ``known``. ``cache`` is the folder of the response log: what stands there isn't asked again, and new answers
    are added. Each document's files have a folder of their own if there are several."""
    docs = markdown.documents(spark, source)
    if not docs.limit(1).count():
        raise PipelineError(Severity.FATAL, "scan", "no document", location=source)
    m, uncertain = markdown.model(docs)
    m = materialised(markdown.resolved(m))
    if provider is not None and uncertain.limit(1).count():
        m, uncertain, new = reviewed_model(m, uncertain, provider, m.classes.select("name") if known is None else known, read_cache(spark, cache), tries)
        if cache is not None:
            append_cache(new, cache)
    files = emit.emitted(m, forms)
    several = docs.limit(2).count() > 1
    manifest = written(write_files(files, output, by_document=several))
    stats = {r.form: r["count"] for r in files.groupBy("form").count().collect()}
    return Built(m, uncertain, manifest, emit.verified(files), stats)
