"""marketloom: marketplace cleaning, modelling and analysis as Spark DataFrame operators."""
