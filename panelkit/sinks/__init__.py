"""Writers: tables, exports, run registry, manifests."""
