"""Bidding-rule documents.

The document is ``{"default_rules": [{condition, action, percentage,
description}]}``.  It is read with a declared schema through Spark's JSON
reader (so it may live on any shared file system) and, being
configuration, brought to the driver.
"""

from __future__ import annotations

import json
import logging

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from adlens.operators.rules import DEFAULT_RULES
from adlens.schema import RULES_DOCUMENT

log = logging.getLogger(__name__)


def read_rules(spark: SparkSession, path: str | None, on_error: str = "raise") -> list[dict]:
    """Rules of the document at ``path``; the default rules when there is none.

    A missing document gives the defaults; a document without a
    ``default_rules`` entry gives no rules (no adjustments).  Text that is not
    JSON, or a document that can't be read, raises; with ``on_error="none"`` it
    gives no rules (the scheduled report's behaviour), with ``"defaults"`` the
    default rules (the recommendation tool's).
    """
    if on_error not in ("raise", "none", "defaults"):
        raise ValueError("on_error must be 'raise', 'none' or 'defaults'")
    defaults = [dict(r) for r in DEFAULT_RULES]
    if path is None:
        return defaults
    instead = {"none": [], "defaults": defaults}.get(on_error)
    schema = T.StructType(RULES_DOCUMENT.fields + [T.StructField("_corrupt_record", T.StringType())])
    try:
        doc = (spark.read.option("multiLine", True).option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", "_corrupt_record").schema(schema).json(path))
        rows = doc.select(F.explode_outer("default_rules").alias("r"), "_corrupt_record").collect()   # configuration
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return defaults
        if instead is not None:
            return instead
        raise
    except Exception:
        if instead is not None:
            log.exception("rules document %s can't be read", path)
            return instead
        raise
    if any(row["_corrupt_record"] is not None for row in rows):
        if instead is not None:
            log.error("rules document %s is not valid JSON", path)
            return instead
        raise ValueError(f"rules document {path} is not valid JSON")
    return [row["r"].asDict() for row in rows if row["r"] is not None]


def write_rules(spark: SparkSession, rules: list[dict], path: str) -> None:
    """Write a rules document (one JSON object) to ``path``."""
    text = json.dumps({"default_rules": rules})
    (spark.createDataFrame([(text,)], "value string").coalesce(1)
     .write.mode("overwrite").text(path))
