"""folio: record crosswalk, reconciliation and quality control as Spark jobs.

Layout
------
functions/  Column -> Column building blocks (text, dates, names, fuzzy scores)
operators/  DataFrame -> DataFrame operators (rule tables, crosswalk, matching,
            validation, record updates)
sources/    readers and writers (XML records, CSV authority lists, file
            manifests, document text, error reports, merged batches)
plans/      end-to-end plans over the driver's tables (query catalogue and
            the equivalent DuckDB SQL used as the correctness oracle)
streaming/  the crosswalk applied to a stream of arriving record files
"""

__all__ = ["session"]
