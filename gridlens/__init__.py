"""gridlens: facility analytics expressed as Spark DataFrame operators.

Every operator is a function ``DataFrame -> DataFrame`` (or a small group of
them) that stays lazy, so Catalyst sees the whole plan and the caller decides
when to act.  Subpackages:

* ``functions``  column-expression builders (flags, codes, bins, hashes)
* ``sources``    readers, writers, the derived test bindings
* ``operators``  normalise, clean, density, datasets, upsert, splits, metrics,
                 reports, models
* ``plans``      end-to-end jobs and the query registry used by the driver
* ``streaming``  incremental (file-stream) upsert
"""

from gridlens.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
