"""cardlake: a Spark-native card-fraud warehouse.

Daily batches of transactions, terminals and a passport blacklist plus full
snapshots of clients, accounts and cards are turned into type-2 dimension
history, an append-only transaction fact and an accumulating fraud report.
Every step is a DataFrame -> DataFrame function; IO lives in ``sources`` and
``plans.daily``.
"""

from cardlake.session import get_spark, scratch_dir

__all__ = ["get_spark", "scratch_dir"]
