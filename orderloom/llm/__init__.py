"""Operations of a training-data pipeline over documents, vectors, pages and dialogues.

Nothing else in the package imports this one.
"""
