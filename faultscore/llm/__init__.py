"""Operations of a training-data pipeline over documents, pages and vectors.

Nothing outside this folder imports it; ``__spark_entry__`` adds its queries
when the folder is there.
"""
