"""The steps of the routing job, DataFrame in and DataFrame out."""
