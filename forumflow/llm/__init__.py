"""Training-data operators: ten operators over documents, pages and conversations.

Nothing else in the package imports this one.
"""
