"""quarry: data-mining operators (recommendation, clustering, search ranking,
text mining, classification, graph metrics, social and mail reports) written
as Spark DataFrame jobs.

Every operator is a function from DataFrames (plus plain parameters) to a
DataFrame; Catalyst plans it and Spark runs it.  Iterative operators cut their
lineage with reliable checkpoints in the folder named by
``spark.checkpoint.dir``.
"""

__version__ = "0.1.0"
