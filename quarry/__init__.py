"""quarry: Spark-native preparation and evaluation of language-model text corpora.

Every operator is a ``DataFrame -> DataFrame`` function (use with ``df.transform``)
or a ``Column -> Column`` expression builder. Nothing runs on the driver except
planning and tiny metadata (counts of a few hundred rows at most).

Layout:
  quarry.functions   Column expressions: normalization, hashing, tokens, shingles
  quarry.sources     JSONL / Parquet scans, ingest, sharded sinks
  quarry.operators   filters, exact/near dedup, split/shard/mix, tokenize/pack,
                     language id, n-gram LM, evaluation aggregates
  quarry.plans       options and end-to-end compositions (prepare, eval report)
  quarry.streaming   incremental (file-stream) variant of the prepare stages
"""

from quarry.plans.options import PrepareOptions, NearDupOptions, PackOptions
from quarry.session import get_spark, staging_dir

__all__ = ["PrepareOptions", "NearDupOptions", "PackOptions", "get_spark", "staging_dir"]
