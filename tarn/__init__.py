"""tarn: streaming and lakehouse data operators written on Spark DataFrames."""
