"""Change-event warehousing on PySpark: medallion tables, type-2 history, facts and run state."""
