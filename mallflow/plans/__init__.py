"""Compositions of operators: metric products, day tables, the registered queries and their SQL."""
