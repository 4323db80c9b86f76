"""Writers for files, brokers and delivery counts."""
