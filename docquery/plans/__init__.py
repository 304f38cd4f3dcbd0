"""From filter objects to Catalyst columns: paths, the filter tree, and its lowering."""
