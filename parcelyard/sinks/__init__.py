"""Writers: layer files, warehouse tables, Kafka."""
