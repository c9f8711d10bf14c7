"""Claims tables derived from the test tables, and spoilt copies of them: inputs of tests and registered queries."""
