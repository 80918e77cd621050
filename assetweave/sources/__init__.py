"""Sources: entity snapshots, binary containers, manifests."""
