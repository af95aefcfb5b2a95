"""marisnow — Spark-native engine for image-particle datasets.

Every operator is a plain ``DataFrame -> DataFrame`` function built from the
DataFrame API, so Catalyst prunes columns, pushes filters to the scan and
chooses join strategies.  Sub-packages:

* ``functions``  column expressions (category, path, date/time, labels)
* ``operators``  relational operators (dedup, sampling, export, vectors,
                 nearest neighbours, graphs, density clustering, bundles)
* ``sources``    file listings, metadata readers, runs, images, features
* ``plans``      end-to-end compositions (collect, cluster run, export)
* ``streaming``  incremental metadata ingestion with Structured Streaming
"""

from marisnow.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
