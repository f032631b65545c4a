"""outlyne: what is unusual about an entity, and when did things happen — on Spark DataFrames."""
