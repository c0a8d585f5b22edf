"""Registered queries: each module pairs Spark jobs with an independent SQL answer."""
