"""Column builders: everything here is a native expression unless it says otherwise."""
