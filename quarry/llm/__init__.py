"""Training-data operators: PII, packing, dedup, search, classifiers, mixing, secrets.

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
adds its queries when it is present.  Shared rules of all operators here:

* id and text columns are named by the caller and may be null; further input
  columns, whatever their names, are never read;
* a null text counts as the empty text unless the operator says otherwise;
* an empty table gives an empty result with the documented columns;
* scratch tables go to the shared folder named by ``spark.checkpoint.dir``.
"""
