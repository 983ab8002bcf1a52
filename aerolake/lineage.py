"""What a DataFrame is computed from: its plan in canonical form, and the
versions (path, length, time of change) of the files it reads.

Two DataFrames with equal plans and equal file versions have equal rows, so results
can be kept under these two digests. Plans for which that is not certain have no
identity: random values, Python or other user code, rows that come from
memory partitions, streams, the time of the run, tables without a plain file listing.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Settings that can change a result without showing in its plan.
_SETTINGS = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.caseSensitive",
             "spark.sql.legacy.timeParserPolicy", "spark.sql.mapKeyDedupPolicy")
_STATUS = re.compile(r"path=([^;]*);.*?length=(\d+);.*?modification_time=(\d+);")
_WHOLE = 2 ** 31 - 1


@dataclass(frozen=True)
class Identity:
    """``plan``: digest of the computation; ``versions``: digest of the input files;
    ``files``: (path, length, time of change) of each; ``roots``: where they were listed."""
    plan: str
    versions: str
    files: tuple[tuple[str, int, int], ...]
    roots: tuple[str, ...] = ()


def _digest(*parts: str) -> str:
    h = hashlib.sha256()
    for p in parts:
        h.update(p.encode())
        h.update(b"\0")
    return h.hexdigest()


def _items(seq):
    return [seq.apply(i) for i in range(seq.size())]


def _nodes(plan):
    """All nodes, those of subqueries too."""
    yield plan
    for part in (*_items(plan.children()), *_items(plan.subqueries())):
        yield from _nodes(part)


def _source(node) -> tuple[str, list[tuple[str, int, int]], list[str]] | None:
    """A leaf's description and files; None for one that cannot be told apart by them."""
    kind = node.getClass().getSimpleName()
    if kind in ("OneRowRelation", "OneRowRelation$", "Range"):
        return kind, [], []
    if kind == "LocalRelation":
        return f"{kind} {node.data().mkString(';')}", [], []
    if kind != "LogicalRelation" or node.relation().getClass().getSimpleName() != "HadoopFsRelation":
        return None
    relation = node.relation()
    location = relation.location()
    if not location.getClass().getSimpleName().startswith("InMemoryFileIndex"):
        return None
    location.refresh()  # a listing taken when the DataFrame was made may be old
    files = [(p, int(n), int(t)) for p, n, t in _STATUS.findall(location.allFiles().mkString("\n"))]
    return " ".join([kind, relation.fileFormat().getClass().getName(), relation.options().toString(),
                     relation.dataSchema().json(), relation.partitionSchema().json()]), sorted(files), [p.toString() for p in _items(location.rootPaths())]


def identity(df: DataFrame) -> Identity | None:
    spark: SparkSession = df.sparkSession
    execution = df._jdf.queryExecution()
    if df.isStreaming:
        return None
    # As analysed: it reads no cached tables, and the optimiser may order equal plans unlike.
    plan = execution.analyzed().canonicalized()
    pattern = spark._jvm.org.apache.spark.sql.catalyst.trees.TreePattern
    user_code = (pattern.PYTHON_UDF(), pattern.SCALA_UDF(), pattern.CURRENT_LIKE())
    lines, sources, files, roots = [], [], [], []
    for node in _nodes(plan):
        if not node.deterministic() or any(node.containsPattern(p) for p in user_code) or re.search("Python|Pandas|Arrow|MapPartitions|MapElements|MapGroups|CoGroup|TypedFilter|Script",
                                                 node.getClass().getSimpleName()):
            return None
        # In the order of the walk, the numbers of children and subqueries give the tree.
        lines.append(f"{node.children().size()} {node.subqueries().size()} {node.verboseString(_WHOLE)}")
        if node.children().isEmpty():
            source = _source(node)
            if source is None:
                return None
            sources.append(source[0])
            files.append(source[1])
            roots += source[2]
    settings = "\n".join(f"{k}={spark.conf.get(k)}" for k in _SETTINGS)
    return Identity(_digest(spark.version, settings, *lines, df.schema.json(), *sources),
                    _digest(*map(str, files)), tuple(f for part in files for f in part), tuple(sorted(set(roots))))


def is_stored(df: DataFrame, column: str) -> bool:
    """Whether ``column`` comes as it is from a file relation, so that conditions on
    it can reach the scan; False for one that is computed."""
    execution = df._jdf.queryExecution()
    plan = execution.analyzed()
    found = [a for a in _items(plan.output()) if a.name() == column]
    if len(found) != 1:
        return False
    return any(a.exprId().equals(found[0].exprId()) for leaf in _items(plan.collectLeaves()) for a in _items(leaf.output()))
