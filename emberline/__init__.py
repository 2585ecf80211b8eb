"""emberline: runtime, cycle, fuel and baseline analytics for metered equipment, on Spark DataFrames."""
