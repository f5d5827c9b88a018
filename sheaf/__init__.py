"""sheaf: keyed tables and text columns as Spark DataFrame jobs.

Main entry points:

* ``sheaf.sources.tables``: ``read_table``, ``read_many``, ``table_inventory``, ``prefix_filter``, ...
* ``sheaf.operators.upsert``: ``upsert``, ``bulk_write``, ``merge_tables``, ``apply_mapping``, ...
* ``sheaf.operators.keys``: ``key_profile``, ``add_key``
* ``sheaf.operators.shape``: ``flatten_struct``, ``nest_columns``, ``flatten_json_rows``,
  ``infer_types``, ``infer_mappings``, ``field_stats``, ``geo_point``
* ``sheaf.plans.analyze``: ``tokenize``, ``analyze``, ``analyze_by_lang``, ``with_analyzed``, ...
* ``sheaf.plans.jobs``: ``token_table``, ``term_counts``, ``term_stats``, ``fingerprint_clusters``, ...
* ``sheaf.streaming.incremental``: ``stream_upsert``
"""

__version__ = "0.1.0"
