from callstats.cli import main

main()
