"""loomline: process-mining analytics on event logs, written as Spark plans."""
