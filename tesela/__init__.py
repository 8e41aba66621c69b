"""tesela: open-data procurement and education analytics on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
native column expressions, so Catalyst plans it and whole-stage codegen
runs it. Subpackages:

- ``sources``    readers for landed files, the driver tables and fixture views
- ``functions``  ``Column -> Column`` cleaning rules and fixed vocabularies
- ``operators``  marts, indicators, measures, rankings, validations, documents
- ``plans``      composite jobs, table functions, the query registry
- ``streaming``  incremental ingest of landed page files
"""

__version__ = "0.1.0"
