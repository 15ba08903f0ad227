"""The dataset registry, the warehouse load and the named views."""
