from rowcast.cli import main

main()
