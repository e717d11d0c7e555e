"""haulgrain: shipment-grain logistics analytics on Spark DataFrames."""
