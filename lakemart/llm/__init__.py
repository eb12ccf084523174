"""Training-data operators: text, search and sharding jobs over whole corpora.

One module per operator; ``queries`` registers them for the driver.  Nothing
else in the library imports this subpackage.
"""
