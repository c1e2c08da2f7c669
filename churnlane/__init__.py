"""churnlane: attrition-style risk scoring on Spark DataFrames.

Batch and Structured Streaming pipelines that ingest tables, clean and encode
features, align them to a model's column contract, score them with a logistic
model, threshold and label the rows, persist results and answer directory,
history and detail queries, plus integrity / erasure / registration jobs.

Everything is expressed with the DataFrame / SQL API so Catalyst and AQE plan
it; no collect() of data-sized results happens in library code.
"""

__version__ = "0.1.0"
