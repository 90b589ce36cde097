"""Training-data pipeline operators: thirteen operators over documents, pages and
embeddings, each in a module of its own, and their registered queries
(``registry``). Nothing else in the library imports this subpackage."""
