"""tastegraph: rating analytics and product recommendations on Spark.

Sub-packages:

* ``sources``   - typed table readers, text loaders, sinks and layouts
* ``functions`` - Column -> Column scalar functions
* ``operators`` - statistics, similarity, ItemCF, content, ALS, real-time scoring
* ``plans``     - served queries and the named query register
* ``streaming`` - Structured Streaming jobs around the batch operators
"""

from tastegraph.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
