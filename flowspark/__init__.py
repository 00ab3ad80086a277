"""Visitor-flow analytics on Spark: footfall, influence networks, popularity and circulation."""
