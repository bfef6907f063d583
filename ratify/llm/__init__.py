"""Training-data operators: thirteen corpus jobs over documents and conversations.

Each module holds one operator with a general interface; ``queries`` registers
the thin ``opN_<name>`` queries and ``oracle`` their DuckDB SQL where SQL can
express them.  Nothing else in the package imports this subpackage.
"""
