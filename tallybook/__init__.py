"""tallybook: stock-taking for content-addressed manifests, as Spark jobs.

A manifest is a table of small pointer records (path, SHA-256, byte length).
Every operator is a function from DataFrame to DataFrame that takes its key and
column names as arguments, so one body serves pointer manifests and any other
table of that shape.
"""

__version__ = "0.1.0"
