"""devtrail -- device-lifecycle analytics on Spark DataFrames.

Builds the life story of mobile devices from four raw feeds (factory
shipments, SDAC activation records, check-in logs, repair claims): cleaned and
deduplicated dimension tables, abandon / move / swap events, warranty-tagged
repairs, data-quality side outputs and one wide event timeline.
"""

__version__ = "0.1.0"
