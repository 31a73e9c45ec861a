from loomgraph.cli import main

main()
