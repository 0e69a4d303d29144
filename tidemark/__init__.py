"""Analytics on change-data-capture lakehouses, declared as Spark DataFrame and SQL plans."""
