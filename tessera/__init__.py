"""tessera — gridded earth-observation analytics on Spark.

Scene catalogues, tile gridding, monthly masked composites and bulk
object/document jobs, all expressed as DataFrame / Spark SQL plans.

Layout:
    session      Spark session defaults (UTC, AQE, skew join) and checkpoint dir
    sources/     scans and sinks (catalogue, observations, object inventory)
    functions/   Column-level helpers (JSON fields, time, geometry, pixels, names)
    operators/   relational operators (catalogue views, grid, composite, ranges,
                 orders, object jobs, integrity checks)
    plans/       end-to-end jobs ("get work", "do work", copy-and-edit, refresh)
                 and the registry of checked queries
"""

from tessera.session import get_session, ensure_checkpoint_dir  # noqa: F401

__all__ = ["get_session", "ensure_checkpoint_dir"]
