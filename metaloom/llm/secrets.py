"""Secret scan with corpus-wide ownership frequency.

Each text is scanned for credentials by pattern (kinds assign, access, hex) and for long random-looking strings. Every
candidate's value is hashed, and the hashes are counted over the corpus by distinct owners and repositories: a value
that many owners have is a copied example, one that few have and that looks random is live. Pattern spans always stay;
a random-looking string beside them becomes a span (kind owned) only if its value is live.

Offsets are code points. Null and empty texts have no spans. Null owner or repository is one like any other. Repeated
rows are scanned one by one, and count one owner. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metaloom.llm.common import cut, pick, utf8

#: Owners from which on a value is a copied example, and up to which it can be live.
EXAMPLE_OWNERS, LIVE_OWNERS = 5, 2
#: Repositories from which on a value is a copied example.
EXAMPLE_REPOSITORIES = 10
#: Bits a character that a live value has at least, and the length of a random-looking string.
LEAST_ENTROPY, LEAST_LENGTH = 3.0, 20

KINDS = ("assign", "access", "hex", "owned")
_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE)
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{24,}")
_RANDOM = re.compile(rb"[A-Za-z0-9+_=-]{%d,}" % LEAST_LENGTH)


def entropy(value: bytes) -> float:
    """Bits a character, by the value's own characters."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def random_looking(value: bytes) -> bool:
    mixed = any(48 <= b <= 57 for b in value) and any(b > 57 for b in value)
    return mixed and entropy(value) >= LEAST_ENTROPY


def scan(text: bytes | None) -> list[tuple[int, int, int, str, bool]]:
    """(kind, start, end, hash of the value, whether it looks random), in order of start and kind. Kinds by number."""
    if not text:
        return []
    found = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        found += [(0, *m.span(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in text:
        found += [(1, *m.span(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [(2, *m.span(), m[0]) for m in _HEX.finditer(text)]
    base = [(a, b) for _, a, b, _ in found]
    for m in _RANDOM.finditer(text):
        if random_looking(m[0]) and all(m.end() <= a or m.start() >= b for a, b in base):
            found.append((3, *m.span(), m[0]))
    if not found:
        return []
    found.sort(key=lambda x: (x[1], x[0]))
    places, at, points = {}, 0, 0
    for p in sorted({p for f in found for p in f[1:3]}):
        points += len(text[at:p].decode("utf-8", "replace"))
        places[p] = points
        at = p
    return [(k, places[a], places[b], hashlib.sha256(v).hexdigest(), random_looking(v)) for k, a, b, v in found]


def ownership(candidates: DataFrame) -> DataFrame:
    """owners, repositories and occurrences of each hash, from rows (hash, owner, repository)."""
    each = candidates.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    owners = each.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repositories"), F.sum("n").alias("n"))
    return owners.groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"), F.sum("n").alias("occurrences"))


def find_secrets(
    documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repository_col: str = "lang",
    example_owners: int = EXAMPLE_OWNERS, live_owners: int = LIVE_OWNERS, example_repositories: int = EXAMPLE_REPOSITORIES,
) -> DataFrame:
    """doc_id and spans (start, kind, end, hash, verdict, owners) of every document, in order of start and kind.

    A repository is named by its owner and its own name. Verdicts: example, live, unsure.
    """
    rows = pick(documents, doc_id=id_col, body=text_col, owner=owner_col, repository=repository_col)
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    span = T.StructType([
        T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("hash", T.StringType()), T.StructField("random", T.BooleanType()),
    ])
    schema = T.StructType([*(rows.schema[c] for c in ("row", "doc_id", "owner", "repository")), T.StructField("found", T.ArrayType(span))])
    arrow_span = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("hash", pa.string()), ("random", pa.bool_())])
    names = [f.name for f in span]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(zip(names, x)) for x in scan(t)] for t in utf8(batch, "body")]
            kept = [batch.column(c) for c in ("row", "doc_id", "owner", "repository")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.list_(arrow_span))], names=schema.names)

    scanned = cut(rows.mapInArrow(search, schema))
    each = scanned.where(F.size("found") > 0).select("row", "owner", "repository", F.inline("found"))
    owned = ownership(each)
    verdict = (
        F.when((F.col("owners") >= example_owners) | (F.col("repositories") >= example_repositories), "example")
        .when((F.col("owners") <= live_owners) & F.col("random"), "live").otherwise("unsure")
    )
    judged = each.join(owned, "hash").withColumn("verdict", verdict).where((F.col("kind") < 3) | (F.col("verdict") == "live"))
    spans = judged.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end", "hash", "verdict", "owners"))).alias("spans"))
    empty = F.array().cast(spans.schema["spans"].dataType)
    return scanned.select("row", "doc_id").join(spans, "row", "left").select("doc_id", F.coalesce("spans", empty).alias("spans"))


def listed(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.concat_ws(",", F.transform(spans, one))
