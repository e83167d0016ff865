"""The case-surveillance application: cleaning, star schema, marts, feeds, checks."""
