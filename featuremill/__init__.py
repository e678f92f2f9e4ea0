"""featuremill: DataFrame operators that turn business, activity, review and user
tables into one wide feature table per business, plus Spark ML training,
tuning and exact evaluation on top of it."""

__version__ = "0.1.0"
