"""Layered (raw, silver, gold) analytics jobs written as Spark DataFrame plans."""
