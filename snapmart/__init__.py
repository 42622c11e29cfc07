"""snapmart: snapshot-to-mart analytics as composable Spark DataFrame operators.

Every public operator takes and returns a ``DataFrame`` (plus column-name
parameters) and is built from native Spark expressions, so Catalyst can prune
columns, push filters into the scan and keep the work inside whole-stage codegen.

Layout
------
``functions``  column expressions (keys, hashes, guarded arithmetic, formats, casts)
``sources``    file scans, header contracts, lineage, sinks, versioned table store
``operators``  dedupe, quality report, upsert, aggregates, rankings, top-k, marts
``plans``      the activity snapshot derived from the driver tables, and the
               gated end-to-end runs built from the operators
``streaming``  incremental ingest of newly arrived files (Structured Streaming)
"""

from snapmart.session import build_session, checkpoint_root, ensure_checkpoint_dir

__all__ = ["build_session", "checkpoint_root", "ensure_checkpoint_dir"]
__version__ = "0.1.0"
