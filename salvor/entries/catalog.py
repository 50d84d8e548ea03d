"""All registered queries."""

from salvor.entries import analyses, basics, features, models, training

QUERIES = {**basics.QUERIES, **analyses.QUERIES, **features.QUERIES, **models.QUERIES, **training.QUERIES}
