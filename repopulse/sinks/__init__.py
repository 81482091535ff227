"""Tables on shared storage and staging for serving databases."""
