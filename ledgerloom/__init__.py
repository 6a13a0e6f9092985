"""Medallion analytics for bank ledgers, written as Spark DataFrame plans."""
