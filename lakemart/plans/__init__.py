"""Layer builders (silver, gold), query plans (metrics, measures, DQ) and the
pipeline runner (the only writer)."""
